"""Waiting times and split failures from raw controller events."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.functions.columns import floor_minutes, micros_between, naive_as_utc, seconds_between
from corridor_metrics.functions.measures import ratio
from corridor_metrics.operators.scale import checked_join

SPLIT_FAILURE_SHARE = 0.8
RED_SECONDS = 5
MINUTE = 60_000_000  # microseconds


def next_event(events: DataFrame, start_code: int, end_code: int, keys: Sequence[str]) -> DataFrame:
    """Each start event with the time of the next end event of the same keys.

    Equal events are merged first (``n`` counts them), so an hour of a key holds no
    more rows than the clock has ticks. Every hour is scanned on its own; an hour
    without a later end takes the first end of the hours after it, from a frame with
    one row per key and hour.
    """
    keys = list(keys)
    block = [*keys, "_hour"]
    rows = (
        events.where(F.col("eventcode").isin(start_code, end_code))
        .dropna(subset=[*keys, "timestamp"])
        .groupBy(*keys, "timestamp")
        .agg(
            F.count_if(F.col("eventcode") == start_code).alias("n"),
            F.max(F.when(F.col("eventcode") == end_code, F.col("timestamp"))).alias("_end"),
        )
        .withColumn("_hour", floor_minutes("timestamp", 60))
    )
    ahead = Window.partitionBy(*block).orderBy("timestamp").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    later = Window.partitionBy(*keys).orderBy("_hour").rowsBetween(1, Window.unboundedFollowing)
    carry = (
        rows.groupBy(*block)
        .agg(F.min("_end").alias("_first_end"))
        .withColumn("_carry", F.min("_first_end").over(later))
        .select(*block, "_carry")
    )
    return (
        rows.withColumn("end", F.min("_end").over(ahead))
        .where(F.col("n") > 0)
        .join(carry, block, "left")
        .select(*keys, F.col("timestamp").alias("start"), F.coalesce("end", "_carry").alias("end"), "n")
    )


def ped_delay(
    events: DataFrame, start_code: int = 45, end_code: int = 21, keys: Sequence[str] = ("signalid", "eventparam")
) -> DataFrame:
    """Average seconds from a button press to the next start of walk, by signal and day."""
    waits = next_event(events, start_code, end_code, keys).where(F.col("end").isNotNull())
    micros = micros_between("start", "end") * F.col("n")
    return (
        waits.withColumn("_us", micros)
        .groupBy(F.col("signalid").alias("SignalID"), F.to_date("start").alias("Date"))
        .agg(ratio(F.sum("_us").cast("double"), F.sum("n") * F.lit(1e6)).alias("ped_delay"))
    )


def own_level(start: Column, end: Column, unit: int) -> Column:
    """The least level whose blocks, ``unit`` microseconds doubled once per level, are as long as an interval."""
    return F.coalesce(F.greatest(F.ceil(F.log2((end - start) / F.lit(unit))), F.lit(0)), F.lit(0)).cast("int")


def _placed(df: DataFrame, start: str, end: str, unit: int, own: int, up: int, other: str) -> DataFrame:
    """One row per block that an interval touches, at its own level and at those levels above it in ``other``.

    At its own level and above an interval touches two blocks, or three where it ends on an edge. ``_role`` says whom a row may
    meet: 0 both at their own level, else one at its own level and one above its own.
    """
    level = F.col("_own")
    above = F.transform(F.filter(other, lambda x: x > level), lambda x: F.struct(F.lit(up).alias("_role"), x.alias("_level")))
    here = F.array(F.struct(F.lit(0).alias("_role"), level.alias("_level")))
    waiting = F.when(level > 0, F.array(F.struct(F.lit(own).alias("_role"), level.alias("_level")))).otherwise(F.array().cast("array<struct<_role: int, _level: int>>"))
    size = F.lit(unit) * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
    return (
        df.select("*", F.inline(F.concat(here, waiting, above)))
        .withColumn("_size", size)
        .withColumn("_slot", F.explode(F.sequence(F.floor(F.col(start) / F.col("_size")), F.floor(F.col(end) / F.col("_size")))))
    )


def overlaps(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_ends: tuple[str, str], right_ends: tuple[str, str], unit: int
) -> DataFrame:
    """Pairs of blocks of overlapping intervals with equal keys, and ``shared``, the microseconds both hold within the block.

    Ends are in microseconds. Blocks are dyadic: an interval is placed at the level of its own length, and the shorter of two
    meets the longer one at the longer one's level. So an interval of any length is in O(log) rows, and only
    levels that occur among the other side's intervals of the same keys are used. Shares of a pair add up over its blocks.
    """
    def levels(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.collect_set("_own").alias(name))

    left = left.withColumn("_own", own_level(*map(F.col, left_ends), unit))
    right = right.withColumn("_own", own_level(*map(F.col, right_ends), unit))
    a = _placed(checked_join(left, levels(right, "_theirs"), keys), *left_ends, unit, 1, 2, "_theirs").drop("_own", "_theirs", "_size")
    b = _placed(checked_join(right, levels(left, "_theirs"), keys), *right_ends, unit, 2, 1, "_theirs").drop("_own", "_theirs")
    met = a.join(b, [*keys, "_role", "_level", "_slot"])
    first = F.greatest(F.col(left_ends[0]), F.col(right_ends[0]), F.col("_slot") * F.col("_size"))
    last = F.least(F.col(left_ends[1]), F.col(right_ends[1]), (F.col("_slot") + 1) * F.col("_size"))
    return met.withColumn("shared", F.greatest(last - first, F.lit(0))).drop("_role", "_level", "_slot", "_size")


def split_failures(
    cycle: DataFrame, detections: DataFrame, det_config: DataFrame, interval_minutes: int = 60,
    green_code: int = 1, red_code: int = 10, on_code: int = 82, off_code: int = 81,
    share: float = SPLIT_FAILURE_SHARE, red_seconds: int = RED_SECONDS,
    slot_minutes: int = 1, until: dt.datetime | None = None,
) -> DataFrame:
    """Cycles whose detectors stay occupied both through green and into red.

    ``cycle`` names its phase ``CallPhase``. A green runs to the next red of its
    phase; the start of red is its first seconds. Occupancy is the occupied part of
    a window, averaged over the detectors of the phase. Intervals meet in blocks of time of
    ``slot_minutes`` and its doublings (``overlaps``), so a detector that is on for days is a few rows.
    A detector that is still on at the end of the log is occupied up to ``until``, if that is given.
    Nothing is left out for its length.
    """
    phase = ["signalid", "CallPhase"]
    green = next_event(cycle, green_code, red_code, phase).where(
        F.col("end").isNotNull() & (F.col("end") > F.col("start"))
    )
    windows = green.select(
        *phase, F.col("start").alias("green"),
        F.inline(
            F.array(
                F.struct(F.lit("g").alias("part"), F.col("start").alias("ws"), F.col("end").alias("we")),
                F.struct(
                    F.lit("r").alias("part"), F.col("end").alias("ws"),
                    (F.col("end") + F.make_dt_interval(secs=F.lit(red_seconds).cast("decimal(18,6)"))).alias("we"),
                ),
            )
        ),
    )
    detectors = det_config.where(F.col("CallPhase").isNotNull()).select(
        "signalid", "eventparam", F.col("CallPhase").cast("long").alias("CallPhase")
    )
    lanes = detectors.groupBy(*phase).agg(F.count_distinct("eventparam").alias("lanes"))
    held = next_event(detections, on_code, off_code, ["signalid", "eventparam"])
    if until is not None:
        held = held.withColumn("end", F.coalesce("end", F.lit(until).cast("timestamp_ntz")))
    held = held.where(F.col("end").isNotNull() & (F.col("end") >= F.col("start")))
    # a detector that reports "on" twice is occupied once, from the first report
    first_on = held.groupBy("signalid", "eventparam", F.col("end").alias("de")).agg(F.min("start").alias("ds"))
    occupied = checked_join(first_on, detectors, ["signalid", "eventparam"])
    micros = {c: F.unix_micros(naive_as_utc(c)) for c in ("ws", "we")}
    spans = windows.select(*phase, "green", "part", "ws", *[m.alias(f"_{c}") for c, m in micros.items()])
    held_spans = occupied.select(*phase, *[F.unix_micros(naive_as_utc(c)).alias(f"_{c}") for c in ("ds", "de")])
    used = (
        overlaps(spans, held_spans, phase, ("_ws", "_we"), ("_ds", "_de"), slot_minutes * MINUTE)
        .groupBy(*phase, "green", "part", "ws")
        .agg((F.sum("shared") / F.lit(1e6)).alias("busy"))
    )
    whole = checked_join(windows.join(used, [*phase, "green", "part", "ws"], "left"), lanes, phase)
    occupancy = ratio(F.coalesce("busy", F.lit(0.0)), seconds_between("ws", "we") * F.col("lanes"))
    cycles = whole.withColumn("_o", occupancy).groupBy(*phase, "green").agg(
        F.max(F.when(F.col("part") == "g", F.col("_o"))).alias("green_occupancy"),
        F.max(F.when(F.col("part") == "r", F.col("_o"))).alias("red_occupancy"),
    )
    failed = (F.col("green_occupancy") >= share) & (F.col("red_occupancy") >= share)
    return cycles.groupBy(
        F.col("signalid").alias("SignalID"), "CallPhase", floor_minutes("green", interval_minutes).alias("Timeperiod")
    ).agg(F.count("*").alias("cycles"), F.count_if(failed).alias("split_failures"))

