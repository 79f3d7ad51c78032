"""Domain views over the generic benchmark tables.

Every view is a plain projection or grouping of the given tables, so its size
follows theirs. ``registry/sqlviews.py`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns of the benchmark tables that the views use.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


class Tables:
    """Lazy readers of the benchmark tables of one folder; declared columns spare a look into the files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")


def event_log(t: Tables) -> DataFrame:
    code = (
        F.when(F.col("event_type") == "click", 82).when(F.col("event_type") == "view", 81)
        .when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "signup", 90)
        .when(F.col("event_type") == "error", 0)
    )
    return t.events.select(
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("signalid"),
        code.alias("eventcode"),
        (F.get_json_object("props", "$.k").cast("int") % 4).alias("eventparam"),
    )


def det_config(t: Tables) -> DataFrame:
    param = F.col("eventparam")
    phase = F.when(param == 0, 2).when(param == 1, 6).when(param == 2, 4)
    return event_log(t).select("signalid", "eventparam").distinct().withColumn("CallPhase", phase)


def cycle_events(t: Tables) -> DataFrame:
    """Phase events: the parameter stands for the phase."""
    return event_log(t).select(
        "timestamp", "signalid", "eventcode", (F.col("eventparam") * 2).cast("long").alias("CallPhase")
    )


# Zone names by region.
ZONES = {0: ("Zone 1", "Zone 2"), 1: ("Zone 7m", "Zone 7d"), 2: ("Zone 3", "Zone 8"), 3: ("Zone 4", "Zone 5"), 4: ("Zone 6", "Zone 9")}


def _zone() -> Column:
    out = F.lit(None).cast("string")
    second = F.floor(F.col("n_nationkey") / 5) % 2 == 1
    for region, (a, b) in ZONES.items():
        out = F.when(F.col("n_regionkey") == region, F.when(second, F.lit(b)).otherwise(F.lit(a))).otherwise(out)
    return out


def places(t: Tables) -> DataFrame:
    """Customers with nation and region; Spark picks the join by the tables' sizes."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def corridors(t: Tables) -> DataFrame:
    group = F.when(F.col("r_regionkey") == 0, "RTOP1").when(F.col("r_regionkey") == 1, "RTOP2").otherwise(F.col("r_name"))
    return places(t).select(
        F.col("c_custkey").alias("SignalID"),
        group.alias("Zone_Group"),
        _zone().alias("Zone"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("n_name")).alias("Corridor"),
        F.col("c_mktsegment").alias("Subcorridor"),
        F.concat(F.col("n_name"), F.lit(" @ "), F.col("c_mktsegment")).alias("Name"),
    )


def _from_2024(days: int, minutes: Column) -> Column:
    """A time in the first ``days`` of 2024, by ship date."""
    day = F.pmod(F.datediff(F.to_date("l_shipdate"), F.lit("1995-01-01").cast("date")), F.lit(days))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(day, F.lit(0), minutes.cast("int"))


def counts(t: Tables) -> DataFrame:
    """15-minute detector volumes."""
    at = _from_2024(30, (F.col("l_partkey") % 96) * 15)
    line = F.col("l_linenumber")
    phase = F.when(line % 4 == 0, 2).when(line % 4 == 1, 6).when(line % 4 == 2, 4)
    return (
        t.lineitem.select(
            (F.col("l_suppkey") % 20).alias("signalid"), line.cast("long").alias("eventparam"), at.alias("timeperiod"),
            phase.alias("CallPhase"), "l_quantity",
        )
        .groupBy("signalid", "timeperiod", "eventparam", "CallPhase")
        .agg(F.sum("l_quantity").cast("long").alias("vol"))
    )


def counts_with_gaps(t: Tables) -> DataFrame:
    gap = (F.col("eventparam") == 4) & (F.hour("timeperiod") < 3)
    return counts(t).withColumn("vol", F.when(~gap, F.col("vol")))


def report_counts(t: Tables) -> DataFrame:
    return counts(t).select(
        F.col("signalid").alias("SignalID"), F.col("eventparam").alias("Detector"),
        F.col("timeperiod").alias("Timeperiod"), "CallPhase", "vol", F.to_date("timeperiod").alias("Date"),
    )


THRESHOLDS = {
    "1 hour": {"max_volume": 1200, "max_abs_delta": 200, "max_flat": 5},
    "15 min": {"max_volume": 60, "max_abs_delta": 40, "max_flat": 3},
}


def daily_metric(t: Tables) -> DataFrame:
    """A signal metric in whole percent with its weight, so that sums are exact in any order."""
    return t.lineitem.select(
        F.col("l_suppkey").alias("SignalID"),
        F.to_date("l_shipdate").alias("Date"),
        F.round(F.col("l_discount") * 100).alias("uptime"),
        F.col("l_quantity").alias("num"),
    )


def hourly_metric(t: Tables) -> DataFrame:
    """One value per signal and hour."""
    hour = F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.minute("ts"), F.date_part(F.lit("SECOND"), "ts"))
    return t.events.groupBy(F.col("user_id").alias("SignalID"), hour.alias("Hour")).agg(
        F.sum(F.floor("value")).cast("double").alias("vph")
    )


def event_metric(t: Tables) -> DataFrame:
    """Event values with the hour they belong to."""
    return t.events.select(
        F.col("user_id").alias("SignalID"), F.col("ts").alias("Date_Hour"), F.to_date("ts").alias("Date"),
        F.floor("value").cast("double").alias("v"),
    )


def camera_log(t: Tables) -> DataFrame:
    """Image log with HTTP dates."""
    return t.events.select(
        F.concat(F.lit("CAM-"), F.col("user_id")).alias("ID"),
        F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("Last-Modified"),
        F.floor(F.col("value") * 100).alias("Content-Length"),
        F.to_date("ts").alias("date"),
    )


def encoder_log(t: Tables) -> DataFrame:
    return t.events.select(
        F.concat(F.lit("CAM-"), F.col("user_id")).alias("CameraID"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Datetime"),
        F.floor(F.col("value") * 100).alias("Size"),
        F.to_date("ts").alias("date"),
    )


def readings(t: Tables) -> DataFrame:
    """Speed readings of road segments, at a minute derived from the order."""
    minute = _from_2024(90, F.col("l_orderkey") % 1440)
    return t.lineitem.select(
        F.col("l_partkey").cast("string").alias("tmc_code"), minute.alias("measurement_tstamp"),
        F.col("l_quantity").alias("speed"), (F.col("l_linenumber") * 10).cast("double").alias("reference_speed"),
    )


def segments(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").cast("string").alias("tmc"), (F.col("p_retailprice") / 1000).alias("miles"),
        F.col("p_brand").alias("Corridor"), F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("Subcorridor"),
    )


def speeds(t: Tables) -> DataFrame:
    """Readings with corridor names, as stored by the travel-time job; no subcorridor is ``None``."""
    seg = segments(t).withColumn("Subcorridor", F.coalesce("Subcorridor", F.lit("None")))
    return (
        readings(t).join(seg, F.col("tmc") == F.col("tmc_code")).drop("tmc")
        .withColumnRenamed("measurement_tstamp", "Minute")
    )


def speed_limits(t: Tables) -> DataFrame:
    limit = (25 + 5 * (F.length("p_type") % 5)).cast("double").alias("Speed Limit")
    pairs = t.part.select(F.col("p_brand").alias("Corridor"), F.col("p_type").alias("Subcorridor"), limit).distinct()
    whole = t.part.select(
        F.col("p_brand").alias("Corridor"), F.lit(None).cast("string").alias("Subcorridor"),
        (30 + F.length("p_brand")).cast("double").alias("Speed Limit"),
    ).distinct()
    return pairs.unionByName(whole)


def injury_reference(t: Tables) -> DataFrame:
    """Injury share per speed bin, for the speeds of 20 and more that occur."""
    bins = t.lineitem.where(F.col("l_quantity") >= 20).select(F.col("l_quantity").alias("mph_bin")).distinct()
    return bins.withColumn("pct", F.col("mph_bin") / 100)


def _position(axis: int) -> Column:
    return F.element_at("embedding", axis).cast("double") / 25


def intersections(t: Tables) -> DataFrame:
    rows = t.embeddings.where(F.col("vec_id") % 2 == 0)
    return rows.select(
        F.col("vec_id").cast("string").alias("SignalID"),
        F.concat(F.lit("Main "), F.col("label")).alias("PrimaryName"),
        F.concat(F.lit("Side "), F.col("vec_id")).alias("SecondaryName"),
        _position(1).alias("Longitude"), _position(2).alias("Latitude"),
    )


def locations(t: Tables) -> DataFrame:
    rows = t.embeddings.where(F.col("vec_id") % 2 == 1)
    return rows.select(
        F.col("vec_id").alias("DB Id"),
        F.concat(F.lit("Crew "), F.col("label")).alias("Maintained By"),
        F.concat((F.col("vec_id") - 1).cast("string"), F.lit(" box")).alias("Custom Identifier"),
        F.concat(F.lit("City "), F.col("label") % 5).alias("City"),
        F.concat(F.lit("County "), F.col("label") % 3).alias("County"),
        _position(1).alias("Longitude"), _position(2).alias("Latitude"),
    )


def progress(t: Tables) -> DataFrame:
    """Report entries: several versions per month and zone, with equal stamps."""
    return t.orders.select(
        F.to_date(F.trunc(F.to_date("o_orderdate"), "month")).alias("Month"), F.col("o_orderpriority").alias("Zone"),
        F.col("o_orderdate").alias("LastModified"), F.col("o_orderkey").alias("entry"),
    )


def corridor_history(t: Tables) -> DataFrame:
    """Corridor source rows: every order is a version of its customer's signal."""
    rows = t.orders.join(places(t), F.col("o_custkey") == F.col("c_custkey"))
    key = F.col("o_orderkey")
    return rows.select(
        F.col("o_custkey").cast("double").alias("SignalID"),
        F.when(F.col("r_regionkey") == 0, "RTOP1").when(F.col("r_regionkey") == 1, "RTOP2").otherwise(F.col("r_name")).alias("Contract"),
        F.when(key % 3 == 0, F.col("r_name")).otherwise(_zone()).alias("District"),
        F.when(F.col("o_custkey") % 11 != 0, F.concat(F.lit(" "), F.col("n_name"))).alias("Corridor"),
        F.col("c_mktsegment").alias("Subcorridor"),
        F.lit("County").alias("Agency"),
        F.concat(F.col("n_name"), F.lit(" ")).alias("Main Street Name"),
        F.col("o_orderpriority").alias("Side Street Name"),
        (F.col("o_totalprice")).alias("Milepost"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (key % 86400).cast("decimal(18,6)"))).alias("Asof"),
        (key % 5 != 0).alias("Include"),
        F.when(key % 4 != 0, F.col("o_orderdate")).alias("Modified"),
        (F.col("o_custkey") % 90).cast("double").alias("Latitude"),
        (F.col("o_custkey") % 180).cast("double").alias("Longitude"),
        key.alias("version"),
    )


def mart(t: Tables) -> DataFrame:
    """Monthly corridor mart of order values in whole units."""
    rows = t.orders.join(corridors(t), F.col("o_custkey") == F.col("SignalID")).where(F.col("Corridor").isNotNull())
    month = F.to_date(F.trunc(F.to_date("o_orderdate"), "month"))
    return rows.groupBy("Zone_Group", "Zone", "Corridor", month.alias("Month")).agg(
        F.sum(F.floor("o_totalprice")).cast("double").alias("tp"), F.count("*").alias("ones")
    )
