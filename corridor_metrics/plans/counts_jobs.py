"""Counts-based jobs: one plan over the whole date range per output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor_metrics.context import RunContext, scratch_path
from corridor_metrics.functions.dates import Span, add_months, spans_of, without_spans
from corridor_metrics.operators.activity import activity_counts, hour_masks, signal_activity, uptime_of
from corridor_metrics.operators.counts import (
    adjusted_counts, filtered_counts, signal_event_counts, throughput, vehicles_per_day,
    vehicles_per_period, with_phase,
)
from corridor_metrics.operators.delays import ped_delay, split_failures
from corridor_metrics.operators.filters import report_names
from corridor_metrics.plans.signal_detail import signal_details
from corridor_metrics.sources import versions
from corridor_metrics.sources.lake import events_of, listed_dates
from corridor_metrics.sources.sinks import text_keys, with_date, write_by_date


def _suffix(interval: str) -> str:
    return {"1 hour": "1hr", "15 min": "15min"}[interval]


COUNT_COLUMNS = ["signalid", "timeperiod", "eventparam", "CallPhase", "vol"]
UNITS = {"1 hour": "hours", "15 min": "15min"}


def counts_outputs(activity: DataFrame, det_config: DataFrame, ctx: RunContext, interval: str = "1 hour") -> dict[str, DataFrame]:
    """Communications uptime, counts and filtered counts of a date range, all from the staged activity."""
    last = dt.datetime.combine(ctx.end_date, dt.time(23, 59))
    counts = with_phase(activity_counts(activity), det_config).select(*COUNT_COLUMNS)
    return {
        "comm_uptime": uptime_of(hour_masks(activity), ctx.start_date, last)["sig"],
        f"counts_{_suffix(interval)}": counts,
        f"filtered_counts_{_suffix(interval)}": filtered_counts(counts, interval, thresholds=ctx.thresholds),
    }


def daily_outputs(activity: DataFrame, det_config: DataFrame, ctx: RunContext, interval: str = "1 hour") -> dict[str, DataFrame]:
    """The same outputs with every day on its own, so that days can be computed in any order and division."""
    counts = with_phase(activity_counts(activity), det_config).select(*COUNT_COLUMNS)
    return {
        "comm_uptime": uptime_of(hour_masks(activity))["sig"],
        f"counts_{_suffix(interval)}": counts,
        f"filtered_counts_{_suffix(interval)}": filtered_counts(counts, interval, thresholds=ctx.thresholds, history=False),
    }


def staged_activity(events: DataFrame, interval: str) -> DataFrame:
    """The activity of some events as a written table: the only scan of the events."""
    spark = events.sparkSession
    path = scratch_path(spark, "activity")
    signal_activity(events, UNITS[interval]).write.parquet(path)
    return spark.read.parquet(path)


def run_counts(events: DataFrame, det_config: DataFrame, ctx: RunContext, interval: str = "1 hour") -> list[str]:
    """Write the counts outputs by date; an empty output leaves its table as it is. The events are read once."""
    outputs = counts_outputs(staged_activity(events, interval), det_config, ctx, interval)
    for table, df in outputs.items():
        write_by_date(report_names(df), ctx.root, table)
    return list(outputs)


def continue_counts(
    spark: SparkSession, lake_root: str, table: str, det_config: DataFrame, ctx: RunContext, interval: str = "1 hour"
) -> list[Span]:
    """Compute the dates of the run that the lake holds and no run before has finished; returns their spans.

    The finished dates are kept as spans in the state that also names the current outputs, so a
    date is finished if and only if all its outputs can be read. A run that fails leaves the state as it was. Dates that
    come late, between finished ones, are computed by the next run, alone; ``versions.reopen`` makes it
    compute dates again. A job that lost its state would start anew, from the dates of the lake.
    """
    state = versions.newest(spark, ctx.root)
    held = spans_of(day for day in listed_dates(spark, f"{lake_root}/{table}") if ctx.start_date <= day <= ctx.end_date)
    todo = without_spans(held, versions.finished(state))
    if todo:
        activity = staged_activity(events_of(spark, lake_root, table, todo), interval)
        outputs = daily_outputs(activity, det_config, ctx, interval)
        rows = {name: text_keys(with_date(report_names(df))).withColumnRenamed("Date", "date") for name, df in outputs.items()}
        versions.publish_dates(spark, ctx.root, rows, todo)
        versions.prune(spark, ctx.root)
    return todo


def month_range(month: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of a month, cut at the end of the run."""
    return month.replace(day=1), min(add_months(month, 1) - dt.timedelta(days=1), end)


def stage_adjusted(filtered: DataFrame, start: dt.date, end: dt.date, mode: str = "as_coded") -> DataFrame:
    """Adjusted counts of a date range; the shuffle keys take the place of staged groups."""
    return adjusted_counts(filtered.where(F.to_date("timeperiod").between(F.lit(start), F.lit(end))), mode)


VOLUME = ["SignalID", "CallPhase", "Detector", "Timeperiod", "Date", "vol"]


def dated(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Counts of a date range under report names, with ``Date``."""
    rows = report_names(df.where(F.to_date("timeperiod").between(F.lit(start), F.lit(end))))
    return rows if "Date" in rows.columns else rows.withColumn("Date", F.to_date("Timeperiod"))


def month_outputs(
    filtered_1hr: DataFrame, filtered_15min: DataFrame, month: dt.date, ctx: RunContext, mode: str = "as_coded"
) -> dict[str, DataFrame]:
    """Adjusted counts, volumes and throughput of a month."""
    start, end = month_range(month, ctx.end_date)
    hour = dated(stage_adjusted(filtered_1hr, start, end, mode), start, end).select(*VOLUME)
    quarter = dated(stage_adjusted(filtered_15min, start, end, mode), start, end).select(*VOLUME)
    return {
        "adjusted_counts_1hr": hour,
        "adjusted_counts_15min": quarter,
        **volume_outputs(hour, quarter),
    }


def volume_outputs(hour: DataFrame, quarter: DataFrame) -> dict[str, DataFrame]:
    """The measures that are built from adjusted counts."""
    return {
        "vehicles_pd": vehicles_per_day(hour),
        "vehicles_ph": vehicles_per_period(hour, "1 hour"),
        "throughput": throughput(quarter),
        "vehicles_15min": vehicles_per_period(quarter, "15 min"),
    }


def run_month(
    counts_1hr: DataFrame, filtered_1hr: DataFrame, filtered_15min: DataFrame, month: dt.date, ctx: RunContext,
    signals=None, mode: str = "as_coded",
) -> list[str]:
    """Write the month's outputs by date.

    The adjusted counts are written first; the measures and the signal details read
    the written tables, so that they are computed once.
    """
    spark = counts_1hr.sparkSession
    start, end = month_range(month, ctx.end_date)
    staged = month_outputs(filtered_1hr, filtered_15min, month, ctx, mode)
    adjusted = ["adjusted_counts_1hr", "adjusted_counts_15min"]
    write_outputs({table: staged[table] for table in adjusted}, ctx.root)

    def stored(table: str) -> DataFrame:
        rows = spark.read.parquet(f"{ctx.root}/{table}").where(F.col("date").between(F.lit(start), F.lit(end)))
        keys = {c: F.col(c).cast("long") for c in ("SignalID", "Detector", "CallPhase")}
        return rows.withColumns(keys).withColumnRenamed("date", "Date")

    hour, quarter = (stored(table) for table in adjusted)
    details = signal_details(dated(counts_1hr, start, end), dated(filtered_1hr, start, end), hour, signals)
    measures = {**volume_outputs(hour, quarter), "signal_details": details.withColumnRenamed("date", "Date")}
    write_outputs(measures, ctx.root)
    return [*adjusted, *measures]


def queue_spillback(events: DataFrame) -> dict[str, DataFrame]:
    return {
        "queue_spillback": signal_event_counts(events, "hour"),
        "queue_spillback_15min": signal_event_counts(events, "15min"),
    }


def ped_delays(events: DataFrame, **codes) -> dict[str, DataFrame]:
    return {"ped_delay": ped_delay(events, **codes)}


def split_failure_outputs(cycle: DataFrame, detections: DataFrame, det_config: DataFrame, **codes) -> dict[str, DataFrame]:
    return {
        "split_failures": split_failures(cycle, detections, det_config, 60, **codes),
        "split_failures_15min": split_failures(cycle, detections, det_config, 15, **codes),
    }


def write_outputs(outputs: dict[str, DataFrame], root: str) -> None:
    """Write each output by date, over the whole range at once."""
    for table, df in outputs.items():
        write_by_date(df, root, table)
