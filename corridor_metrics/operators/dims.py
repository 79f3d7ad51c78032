"""Corridor, detector, ped and camera dimensions, and their checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor_metrics.functions.columns import crossing_name, labelled, not_before
from corridor_metrics.functions.measures import drop_null_keys
from corridor_metrics.operators.filters import marked_contracts, real_signals
from corridor_metrics.operators.scale import as_of_join, checked_join

# Columns and types of the corridor source.
CORRIDOR_SCHEMA = T.StructType(
    [
        T.StructField("SignalID", T.DoubleType()),
        T.StructField("Contract", T.StringType()),
        T.StructField("District", T.StringType()),
        T.StructField("Corridor", T.StringType()),
        T.StructField("Subcorridor", T.StringType()),
        T.StructField("Agency", T.StringType()),
        T.StructField("Main Street Name", T.StringType()),
        T.StructField("Side Street Name", T.StringType()),
        T.StructField("Milepost", T.DoubleType()),
        T.StructField("Asof", T.TimestampNTZType()),
        T.StructField("Duplicate", T.DoubleType()),
        T.StructField("Include", T.BooleanType()),
        T.StructField("Modified", T.TimestampNTZType()),
        T.StructField("Note", T.StringType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("County", T.StringType()),
        T.StructField("City", T.StringType()),
    ]
)


def trimmed(df: DataFrame) -> DataFrame:
    """Text columns without surrounding blanks."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.trim(F.col(f"`{c}`")) for c in text}) if text else df


def latest_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """First row per key in the given order; each map task already keeps one row per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def corridor_dimension(raw: DataFrame, filter_signals: bool = True, mark_only: bool = False) -> DataFrame:
    """Typed, trimmed corridor rows: the last change per signal, district and corridor."""
    rows = trimmed(raw.withColumn("SignalID", F.col("SignalID").cast("long")))
    if filter_signals:
        rows = real_signals(rows)
    if mark_only:
        rows = marked_contracts(rows)
    never = F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")
    rows = rows.withColumn("Modified", F.coalesce("Modified", never))
    rows = latest_by(rows, ["SignalID", "District", "Corridor"], F.desc("Modified"), F.desc("Asof"))
    named = rows.where(F.col("Corridor").isNotNull()).withColumn(
        "Name", crossing_name("`Main Street Name`", "`Side Street Name`")
    )
    return named.select(
        "SignalID", "District", "Contract", "Corridor", "Subcorridor", "Milepost", "Agency", "Name", "Asof",
        "Latitude", "Longitude", labelled("SignalID", "Name").alias("Description"),
    )


def report_corridors(corridors: DataFrame) -> DataFrame:
    """Contract and district under the names the roll-ups use."""
    return corridors.withColumnsRenamed({"Contract": "Zone_Group", "District": "Zone"})


def corridor_conflicts(corridors: DataFrame) -> dict[str, DataFrame]:
    """Corridors filed under several zones, and corridors that differ by case only."""
    rows = drop_null_keys(corridors.select("District", "Contract", "Corridor").distinct(), "Corridor")

    def repeated(key: Column) -> DataFrame:
        n = F.count("*").over(Window.partitionBy(key))
        return rows.withColumn("_n", n).where(F.col("_n") > 1).drop("_n")

    return {"zones": repeated(F.col("Corridor")), "case": repeated(F.lower("Corridor"))}


def corridors_are_clean(corridors: DataFrame) -> bool:
    return all(found.isEmpty() for found in corridor_conflicts(corridors).values())


def camera_config(cameras: DataFrame, corridors: DataFrame) -> DataFrame:
    """Cameras in use with the corridor of their signal."""
    cams = (
        cameras.where(F.col("Include") & F.col("CameraID").isNotNull())
        .select("CameraID", "Location", F.col("MaxView ID").alias("SignalID"), "As_of_Date")
        .distinct()
    )
    place = corridors.select("SignalID", "Contract", "District", "Corridor", "Subcorridor")
    return (
        checked_join(place, cams, ["SignalID"])
        .withColumn("MaxView ID", F.col("SignalID"))
        .withColumn("Description", labelled("CameraID", "Location"))
        .orderBy("Contract", "District", "Corridor", "CameraID")
    )


def first_config(config: DataFrame, order: str) -> DataFrame:
    """First known phase per detector; NULLs give way to later rows."""
    return (
        drop_null_keys(config, "SignalID", "Detector")
        .groupBy("SignalID", "Detector")
        .agg(F.min_by("CallPhase", F.when(F.col("CallPhase").isNotNull(), F.col(order))).alias("CallPhase"))
    )


def ped_config_on(plans: DataFrame, day: dt.date, order: str, date_col: str = "date") -> DataFrame:
    """Ped buttons of a day (2019 at the earliest); no rows when the day has none."""
    return first_config(plans.where(F.col(date_col) == not_before(F.lit(day))), order)


def det_config_on(config: DataFrame, day: dt.date, order: str, date_col: str = "date") -> DataFrame:
    """Detector phases of a day; an error when the day has no configuration."""
    rows = config.where(F.col(date_col) == F.lit(day))
    if rows.isEmpty():
        raise ValueError(f"No detector config file for {day}")
    return first_config(rows, order)


def latest_det_config(config: DataFrame, as_of: dt.date, date_col: str = "date") -> DataFrame:
    """All rows of the newest configuration that is not newer than ``as_of``."""
    rows = config.where(F.col(date_col) <= F.lit(as_of))
    return rows.where(F.col(date_col) == rows.agg(F.max(date_col)).scalar())


def det_config_dates(days: DataFrame, config: DataFrame, date_col: str = "date") -> DataFrame:
    """For each of the days, the date of the newest configuration that is not newer (``config_date``); NULL before the first.

    Both sides are reduced to their dates first.
    """
    one = F.lit(1).alias("_all")
    asked = days.select(one, F.col(date_col)).distinct()
    given = config.select(one, F.col(date_col), F.col(date_col).alias("config_date")).distinct()
    return as_of_join(asked, given, ["_all"], date_col, ["config_date"]).select(date_col, "config_date")


def det_config_of_days(days: DataFrame, config: DataFrame, date_col: str = "date") -> DataFrame:
    """All rows of the configuration in force on each of the days; ``latest_det_config`` for every date at once."""
    dates = det_config_dates(days, config, date_col).where(F.col("config_date").isNotNull())
    rows = config.withColumnRenamed(date_col, "config_date")
    return checked_join(rows, dates, ["config_date"])
