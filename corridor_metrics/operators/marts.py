"""Parameterised reads of the result marts, report slices and goals."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor_metrics.functions.columns import data_format, delta_text, highlight, naive
from corridor_metrics.functions.dates import add_months
from corridor_metrics.operators.filters import zone_group_predicate
from corridor_metrics.operators.scale import checked_join
from corridor_metrics.sources.versions import read_table

# Short names used in mart tables.
RESOLUTIONS = {"quarterly": "qu", "monthly": "mo", "weekly": "wk", "daily": "dy"}
LEVELS = {"corridor": "cor", "subcorridor": "sub", "signal": "sig"}
HEALTH_LEVELS = {"corridor": "sub", "subcorridor": "sub", "signal": "sig"}

# Metric, name, goal text, goal value, sign.
GOALS = [
    ("du", "Vehicle Detector Availability", "> 95%", 0.95, ">"),
    ("pau", "Ped Pushbutton Availability", "> 95%", 0.95, ">"),
    ("cctvu", "CCTV Availability", "> 95%", 0.95, ">"),
    ("cu", "Communications Uptime", "> 95%", 0.95, ">"),
    ("tp", "Traffic Volume (Throughput)", "< 5% dec. from prev. mo", -0.05, ">"),
    ("aog", "Arrivals on Green", "> 80%", 0.8, ">"),
    ("qs", "Queue Spillback Rate", "< 10%", 0.10, "<"),
    ("sf", "Split Failure", "< 5%", 0.05, "<"),
    ("tti", "Travel Time Index", "< 2.0", 2.0, "<"),
    ("pti", "Planning Time Index", "< 2.0", 2.0, "<"),
    ("tasks", "Outstanding Tasks", "Dec. from prev. mo", 0.0, "<"),
]


def mart_name(level: str, period: str, metric: str) -> str:
    return f"{level}_{period}_{metric}"


def month_stop(month: dt.date) -> dt.date:
    return add_months(month, 1) - dt.timedelta(days=1)


def mart_predicate(
    level: str, resolution: str, hourly: bool, zone_group: str,
    month: dt.date | None, quarter: float | None, upto: bool,
) -> Column:
    """Zone and period condition of a mart read; all of it reaches the Parquet scan."""
    cond = F.lit(True) if level == "signal" and zone_group == "All" else F.col("Zone_Group") == zone_group

    def period(name: str, bound) -> Column:
        return F.col(name) <= F.lit(bound) if upto else F.col(name) == F.lit(bound)

    if hourly and resolution == "monthly":
        last_hour = dt.datetime.combine(month_stop(month), dt.time(23))
        cond = cond & (F.col("Hour") <= naive(last_hour))
        if not upto:
            cond = cond & (F.col("Hour") >= naive(month))
        return cond
    if resolution == "monthly":
        return cond & period("Month", month)
    if resolution == "quarterly":
        return cond & period("Quarter", quarter)
    return cond & period("Date", month_stop(month))


def query_mart(
    spark: SparkSession, root: str, metric: Mapping[str, str], level: str = "corridor", resolution: str = "monthly",
    hourly: bool = False, zone_group: str = "", corridor: str | None = None, month: dt.date | None = None,
    quarter: float | None = None, upto: bool = True,
) -> DataFrame:
    """Read one mart by level, resolution, zone group and period."""
    table = metric["hourly_table"] if hourly and "hourly_table" in metric else metric["table"]
    df = read_table(spark, root, mart_name(LEVELS[level], RESOLUTIONS[resolution], table))
    out = df.where(mart_predicate(level, resolution, hourly, zone_group, month, quarter, upto))
    return out.where(F.col("Corridor") == corridor) if corridor else out


def query_health(
    spark: SparkSession, root: str, metric: str, level: str, zone_group: str, corridor: str | None, month: dt.date
) -> DataFrame:
    """Read a health mart for one month; zone groups widen to their zones."""
    df = read_table(spark, root, mart_name(HEALTH_LEVELS[level], "mo", metric))
    return df.where(zone_group_predicate(level, zone_group, corridor) & (F.col("Month") == F.lit(month)))


def query_user_delay(spark: SparkSession, root: str, zone_group: str, month: dt.date) -> DataFrame:
    df = read_table(spark, root, "cor_mo_hourly_udc")
    return df.where((F.col("Zone") == zone_group) & (F.col("Month") <= F.lit(month)))


def read_signal_data(details: DataFrame, signal: int, start: dt.date, end: dt.date) -> DataFrame:
    """Unnested detail rows of one signal, with the hour as a timestamp."""
    rows = details.where((F.col("SignalID") == signal) & F.col("date").between(F.lit(start), F.lit(end)))
    return (
        rows.select("SignalID", "date", F.explode("data").alias("dat"))
        .select(
            "SignalID", "date", F.col("dat.Hour").alias("hour"), F.col("dat.Detector").alias("Detector"),
            F.coalesce("dat.CallPhase", F.lit(0)).alias("CallPhase"), "dat.vol_rc", "dat.vol_ac", "dat.bad_day",
        )
        .withColumn(
            "Timeperiod",
            F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("hour")),
        )
        .orderBy("Detector", "date", "hour")
    )


def last_modified(df: DataFrame, zone: str | None = None, month: dt.date | None = None) -> DataFrame:
    """Rows with the newest ``LastModified`` of their month and zone; ties stay.

    The newest stamps are aggregated and joined back, so that a month and zone with
    very many rows is never sorted in one task.
    """
    rows = df.where(F.col("Month").isNotNull() & F.col("Zone").isNotNull())
    if zone:
        rows = rows.where(F.col("Zone") == zone)
    if month:
        rows = rows.where(F.col("Month") == F.lit(month))
    newest = rows.groupBy("Month", "Zone").agg(F.max("LastModified").alias("LastModified"))
    return checked_join(rows, newest, ["Month", "Zone", "LastModified"], "left_semi")


def latest_entries(df: DataFrame, tie_break: Column, n: int = 10) -> DataFrame:
    """The ``n`` last modified rows per month and zone; map tasks pre-limit their groups."""
    w = Window.partitionBy("Month", "Zone").orderBy(F.desc("LastModified"), tie_break)
    rows = df.where(F.col("Month").isNotNull() & F.col("Zone").isNotNull() & F.col("LastModified").isNotNull())
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def value_box(
    df: DataFrame, value: str, data_type: str, zone: str, month: dt.date | None = None, quarter: float | None = None
) -> DataFrame:
    """Formatted value and change of one corridor and month, or quarter."""
    when = F.col("Month") == F.lit(month) if quarter is None else F.col("Quarter") == F.lit(quarter)
    return df.where((F.col("Corridor") == zone) & when).select(
        "Corridor", data_format(value, F.lit(data_type)).alias("val"), delta_text("delta").alias("del")
    )


def dashboard_slices(
    weekly: DataFrame, monthly: DataFrame, value: str, month: dt.date, zone_group: str, color: str,
    hourly: DataFrame | None = None, first_day_only: bool = False,
) -> dict[str, DataFrame]:
    """Bars of the month, trend up to its end and hours of the month of a zone group.

    ``first_day_only`` keeps the hours of the month's first day only.
    """
    in_group = F.col("Zone_Group") == zone_group
    line = F.when(F.col("Corridor") == zone_group, 0).otherwise(1)
    out = {
        "month": monthly.where(in_group & (F.col("Month") == F.lit(month)))
        .select("Corridor", F.col(value).alias("var"), highlight("Corridor", zone_group, color).alias("col"))
        .orderBy("var", "Corridor"),
        "week": weekly.where(in_group & (F.col("Date") < F.lit(month_stop(month)))).select(
            "Corridor", "Date", F.col(value).alias("var"), line.alias("col")
        ),
    }
    if hourly is not None:
        stop = month if first_day_only else month_stop(month)
        out["hour"] = hourly.where(in_group & F.to_date("Hour").between(F.lit(month), F.lit(stop))).select(
            "Corridor", "Hour", F.col(value).alias("var"), line.alias("col")
        )
    return out


def goal_table(spark: SparkSession) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("metric", T.StringType()),
            T.StructField("name", T.StringType()),
            T.StructField("goal", T.StringType()),
            T.StructField("goal_value", T.DoubleType()),
            T.StructField("sign", T.StringType()),
        ]
    )
    return spark.createDataFrame(GOALS, schema)


def with_goals(df: DataFrame, value: str) -> DataFrame:
    """Add goal and ``goal_met`` to rows that name their ``metric``."""
    joined = checked_join(df, goal_table(df.sparkSession), ["metric"], "left")
    above, below = F.col(value) > F.col("goal_value"), F.col(value) < F.col("goal_value")
    return joined.withColumn("goal_met", F.when(F.col("sign") == ">", above).when(F.col("sign") == "<", below))


def series_ends(df: DataFrame, value: str, keys: list[str], order: str = "Month") -> DataFrame:
    """First and last value of each series, as used for labels."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))
