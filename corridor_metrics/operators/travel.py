"""Road-segment speeds: relative speed and bike/ped safety indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.functions.measures import drop_null_keys, ratio
from corridor_metrics.operators.scale import checked_join
from corridor_metrics.operators.selection import grouped_percentile


def travel_times(readings: DataFrame, segments: DataFrame) -> DataFrame:
    """Readings with the corridor of their road segment and the reference travel time."""
    segs = segments.where(F.col("Corridor").isNotNull()).select(
        F.col("tmc").alias("tmc_code"), "miles", "Corridor", F.coalesce("Subcorridor", F.lit("None")).alias("Subcorridor")
    )
    return (
        checked_join(readings, segs, ["tmc_code"])
        .withColumn("reference_minutes", ratio(F.col("miles"), F.col("reference_speed").cast("double")) * 60)
        .withColumnRenamed("measurement_tstamp", "Minute")
        .distinct()
    )


def relative_speed_index(
    speeds: DataFrame, limits: DataFrame, grouping: Sequence[str], by: Sequence[str] = (), approx: bool = False,
    accuracy: int = 10_000,
) -> DataFrame:
    """90th percentile of speed over the speed limit of the grouping, for each value of ``by``.

    Speeds are counted per group and value first; the percentile is then selected exactly without a buffer
    of a group's speeds, so they may be continuous. ``approx`` takes one pass, with an error of ``1 / accuracy`` in rank.
    """
    grouping, keys = list(grouping), [*by, *grouping]
    rows = drop_null_keys(speeds, *keys)
    if approx:
        p90 = rows.groupBy(*keys).agg(F.percentile_approx("speed", 0.9, accuracy).cast("double").alias("speed"))
    else:
        counted = rows.groupBy(*keys, "speed").agg(F.count("*").alias("n"))
        p90 = grouped_percentile(counted, keys, "speed", "n", 0.9, "speed")
    bounds = limits.select(*grouping, "Speed Limit")
    return checked_join(p90, bounds, grouping).withColumn("rsi", ratio(F.col("speed"), F.col("Speed Limit").cast("double")))


def corridor_limits(limits: DataFrame) -> DataFrame:
    """Limits stated for a whole corridor."""
    return limits.where(F.col("Subcorridor").isNull())


def speed_shares(speeds: DataFrame, grouping: Sequence[str]) -> DataFrame:
    """Share of each speed value among all rows of its group.

    The window runs over the counted speeds, not over the readings.
    """
    grouping = list(grouping)
    bins = drop_null_keys(speeds, *grouping).groupBy(*grouping, "speed").agg(F.count("*").alias("_n"))
    totals = F.sum("_n").over(Window.partitionBy(*grouping))
    return bins.withColumn("totals", totals).withColumn("count_pct", F.col("_n") / F.col("totals")).drop("_n")


def serious_injury_pct(speeds: DataFrame, reference: DataFrame, grouping: Sequence[str]) -> DataFrame:
    """Bike/ped safety index: Σ over speed bins of share × injury share.

    Shares are of all rows, so speeds missing from the reference lower the result.
    """
    bins = reference.select(F.col("mph_bin").cast("double").alias("speed"), "pct")
    shares = speed_shares(speeds.withColumn("speed", F.col("speed").cast("double")), grouping)
    return (
        checked_join(shares, bins, ["speed"])
        .groupBy(*grouping)
        .agg(F.sum(F.col("count_pct") * F.col("pct")).alias("overall_pct"))
    )
