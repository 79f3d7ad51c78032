"""Detector-uptime and ped-pushbutton reports: signal, corridor, subcorridor by day, week, month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.context import RunContext
from corridor_metrics.functions.measures import drop_null_keys, weighted_mean
from corridor_metrics.operators.counts import daily_ped_activations
from corridor_metrics.operators.filters import low_uptime
from corridor_metrics.operators.marts import mart_name
from corridor_metrics.operators.rollups import (
    corridor_avg_by_day, corridor_uptime, period_avg, signal_uptime, subcorridors_of, with_delta, with_period,
)
from corridor_metrics.operators.scale import checked_join
from corridor_metrics.operators.uptime import daily_detector_uptime, repaired_ped_uptime
from corridor_metrics.sources.sinks import mart_rows, write_by_date
from corridor_metrics.sources.versions import prune, publish_tables

Marts = dict[tuple[str, str], DataFrame]


def detector_uptime_marts(uptime: DataFrame, corridors: DataFrame) -> Marts:
    """Nine marts keyed by level (sig, cor, sub) and resolution (dy, wk, mo).

    Weekly corridor values average the weekly signal values, monthly ones the daily.
    """
    subs = subcorridors_of(corridors)
    daily = daily_detector_uptime(uptime)
    weekly = signal_uptime(daily, "wk")
    marts = {("sig", "dy"): daily, ("sig", "wk"): weekly, ("sig", "mo"): signal_uptime(daily, "mo")}
    for level, dim in (("cor", corridors), ("sub", subs)):
        marts[level, "dy"] = corridor_uptime(daily, dim, "dy")
        marts[level, "wk"] = corridor_uptime(weekly.select("SignalID", "Week", "uptime"), dim, "wk")
        marts[level, "mo"] = corridor_uptime(daily, dim, "mo")
    return marts


def ped_pushbutton_uptime(counts: DataFrame, ctx: RunContext) -> DataFrame:
    """Uptime and repaired daily presses of every ped button since the start of its history."""
    history = counts.where(F.col("Date").between(F.lit(ctx.ped_history_start), F.lit(ctx.end_date)))
    papd = daily_ped_activations(history)
    return repaired_ped_uptime(papd, ctx.ped_history_start, ctx.end_date)


def ped_signal_days(pau: DataFrame) -> DataFrame:
    """Ped-button uptime of a signal and day, as a mean of its buttons (``uptime``, ``ones``) and weighted by ``all`` (``weighed``, ``all``)."""
    return (
        drop_null_keys(pau.withColumns({"ones": F.lit(1), "weighed": F.col("uptime")}), "SignalID", "Date")
        .groupBy("SignalID", "Date")
        .agg(*weighted_mean("uptime", "ones"), *weighted_mean("weighed", "all"))
    )


def ped_pushbutton_marts(pau: DataFrame, corridors: DataFrame) -> Marts:
    """Nine marts of ped-button uptime; the monthly ones weigh by ``all``."""
    return ped_marts_of_days(ped_signal_days(pau), corridors)


def ped_marts_of_days(days: DataFrame, corridors: DataFrame) -> Marts:
    """The nine marts from the signal-days of ``ped_signal_days``."""
    subs = subcorridors_of(corridors)
    plain = days.select("SignalID", "Date", "uptime", "ones")
    weighed = days.select("SignalID", "Date", F.col("weighed").alias("uptime"), "all")
    daily = with_delta(plain, ["SignalID"], "Date", "uptime").select("SignalID", "Date", "uptime", "ones", "delta")
    weekly = signal_uptime(plain, "wk")
    monthly = period_avg(with_period(weighed, "mo")[0], "uptime", "Month", "all")
    marts = {("sig", "dy"): daily, ("sig", "wk"): weekly, ("sig", "mo"): monthly}
    for level, dim in (("cor", corridors), ("sub", subs)):
        marts[level, "dy"] = corridor_avg_by_day(daily, dim, "uptime", "Date")
        marts[level, "wk"] = corridor_avg_by_day(weekly, dim, "uptime", "Week")
        marts[level, "mo"] = corridor_avg_by_day(monthly, dim, "uptime", "Month", "all")
    return marts


PLACE = ["Zone_Group", "Zone", "Corridor", "Subcorridor"]


def with_place(df: DataFrame, corridors: DataFrame) -> DataFrame:
    """Signal rows with the place they are read by; signals without one stay."""
    return checked_join(df, corridors.select("SignalID", *PLACE), ["SignalID"], "left")


def save_marts(marts: Marts, corridors: DataFrame, ctx: RunContext, metric: str) -> list[str]:
    """Write the marts and make them current all at once; a failure on the way leaves all of them as they were.

    Weekly marts may start earlier than the others. Signal marts get their place.
    """
    tables = {
        mart_name(level, per, metric): mart_rows(
            with_place(df, corridors) if level == "sig" else df, per, ctx.wk_calcs_start if per == "wk" else ctx.calcs_start
        )
        for (level, per), df in marts.items()
    }
    spark = corridors.sparkSession
    paths = publish_tables(spark, ctx.root, tables)
    prune(spark, ctx.root)
    return list(paths.values())


def run_detector_uptime(uptime: DataFrame, corridors: DataFrame, ctx: RunContext) -> list[str]:
    """Read once, aggregate to signal-days on disk, then build the marts from that small table.

    The days go back far enough that the first saved week and month, and those before
    them, are complete: change is never taken against a part of a period.
    """
    spark = uptime.sparkSession
    in_range = uptime.where(F.col("Date").between(F.lit(ctx.history_start), F.lit(ctx.end_date)))
    stage = f"{ctx.root}/stage_detector_uptime"
    daily_detector_uptime(in_range).write.mode("overwrite").parquet(stage)
    return save_marts(detector_uptime_marts(spark.read.parquet(stage), corridors), corridors, ctx, "du")


def run_ped_pushbutton_uptime(counts: DataFrame, corridors: DataFrame, ctx: RunContext) -> list[str]:
    """Write ped uptime and bad buttons, then the marts from the written uptime, aggregated to signal-days on disk.

    The days go back far enough for the first saved change of every mart; all buttons have all days.
    """
    spark = counts.sparkSession
    path = f"{ctx.root}/pa_uptime"
    ped_pushbutton_uptime(counts, ctx).write.mode("overwrite").parquet(path)
    pau = spark.read.parquet(path)
    write_by_date(low_uptime(pau, ctx.calcs_start), ctx.root, "bad_ped_detectors")
    stage = f"{ctx.root}/stage_ped_uptime"
    ped_signal_days(pau.where(F.col("Date") >= F.lit(ctx.history_start))).write.mode("overwrite").parquet(stage)
    return save_marts(ped_marts_of_days(spark.read.parquet(stage), corridors), corridors, ctx, "pau")
