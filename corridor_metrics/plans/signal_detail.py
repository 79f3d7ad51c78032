"""Nested hourly detail per signal and day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.operators.filters import of_signals

KEYS = ["SignalID", "Date", "Timeperiod", "Detector", "CallPhase"]
# Fields of a nested detail record.
FIELDS = ["Date", "Detector", "CallPhase", "vol_rc", "Good_Day", "vol_ac", "bad_day", "Hour"]


SIDES = ["_raw", "_filtered", "_adjusted"]


def _merged_sides(raw: DataFrame, filtered: DataFrame, adjusted: DataFrame) -> DataFrame:
    """The merged counts with a flag for each input that has the key."""

    def side(df: DataFrame, column: str, name: str, kind: str, flag: str) -> DataFrame:
        return df.select(*KEYS, F.col(column).cast(kind).alias(name), F.lit(True).alias(flag))

    sides = [
        side(raw, "vol", "vol_rc", "long", SIDES[0]),
        side(filtered, "Good_Day", "Good_Day", "boolean", SIDES[1]),
        side(adjusted, "vol", "vol_ac", "double", SIDES[2]),
    ]
    stacked = sides[0]
    for other in sides[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.groupBy(*KEYS).agg(*[F.max(c).alias(c) for c in ("vol_rc", "Good_Day", "vol_ac", *SIDES)])


def merged_counts(raw: DataFrame, filtered: DataFrame, adjusted: DataFrame) -> DataFrame:
    """Full outer join of the three counts on five keys; NULL phases match each other.

    Each input has one row per key, so one union and one grouping replace two joins
    and their extra shuffle.
    """
    return _merged_sides(raw, filtered, adjusted).drop(*SIDES)


def masked(merged: DataFrame) -> DataFrame:
    """Keep the adjusted volume on bad rows only."""
    bad = F.coalesce(~F.col("Good_Day"), F.lit(False))
    return merged.withColumns(
        {"bad_day": bad, "vol_ac": F.when(bad, F.col("vol_ac")).cast("long"), "Hour": F.hour("Timeperiod")}
    )


def nest(df: DataFrame) -> DataFrame:
    """One row per signal and date with its records in order of detector and hour.

    A record array is bounded by the detectors of a signal times 24.
    """
    record = F.struct("Detector", "Hour", F.struct(*FIELDS).alias("d"))
    return (
        df.where(F.col("SignalID").isNotNull())
        .groupBy("SignalID", F.col("Date").alias("date"))
        .agg(F.transform(F.array_sort(F.collect_list(record)), lambda r: r["d"]).alias("data"))
    )


def unnest(df: DataFrame) -> DataFrame:
    return df.select("SignalID", F.inline("data"))


def signal_details(
    raw: DataFrame, filtered: DataFrame, adjusted: DataFrame, signals: Iterable | DataFrame | None = None
) -> DataFrame:
    """Raw, filtered and adjusted hourly counts, for the days that have all three.

    The days are found in the merged rows, whose shuffle is shared: no input is read twice.
    """
    merged = _merged_sides(raw, filtered, adjusted)
    seen = merged.groupBy("Date").agg(*[F.max(c).alias(c) for c in SIDES])
    days = seen.where(F.col(SIDES[0]) & F.col(SIDES[1]) & F.col(SIDES[2])).select("Date")
    rows = merged.drop(*SIDES).join(days, ["Date"], "left_semi")
    return nest(masked(of_signals(rows, signals)))
