"""One pass over the events for everything a day's job needs: volumes, and the minutes a signal was heard in.

An hour has 60 minutes, so the minutes of a signal and hour are the bits of one ``long``. They are combined by
``bit_or`` in the same aggregation that counts the actuations, before anything is shuffled; communications
uptime and detector counts are both read from that small table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.functions.columns import floor_to_unit
from corridor_metrics.functions.measures import drop_null_keys

GAP_MINUTES = 15
DAY_MINUTES = 60 * 24


def minute_bit(timestamp: Column | str) -> Column:
    """The bit of a minute in the mask of its hour."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.minute(timestamp))


def signal_activity(events: DataFrame, units: str = "hours", event_code: int = 82) -> DataFrame:
    """Per signal, period and detector: ``vol`` events of a code, and ``minutes``, the minutes with any event.

    Events of other codes, or without a detector, are in the row of the period whose ``eventparam`` is NULL and ``vol`` 0.
    """
    counted = (F.col("eventcode") == event_code) & F.col("eventparam").isNotNull()
    return (
        drop_null_keys(events, "signalid", "timestamp")
        .groupBy("signalid", floor_to_unit("timestamp", units).alias("timeperiod"), F.when(counted, F.col("eventparam")).alias("eventparam"))
        .agg(F.count_if(counted).alias("vol"), F.bit_or(minute_bit("timestamp")).alias("minutes"))
    )


def activity_counts(activity: DataFrame) -> DataFrame:
    """The volumes per period, signal and detector."""
    return activity.where(F.col("eventparam").isNotNull()).select("timeperiod", "signalid", "eventparam", "vol")


def hour_masks(activity: DataFrame) -> DataFrame:
    """SignalID, Date, hour and the minutes of that hour, as one mask."""
    keys = [F.col("signalid").alias("SignalID"), F.to_date("timeperiod").alias("Date"), F.hour("timeperiod").alias("hour")]
    return activity.groupBy(*keys).agg(F.bit_or("minutes").alias("minutes"))


def minute_masks(events: DataFrame) -> DataFrame:
    """``hour_masks`` straight from events."""
    keys = [F.col("signalid").alias("SignalID"), F.to_date("timestamp").alias("Date"), F.hour("timestamp").alias("hour")]
    return drop_null_keys(events, "signalid", "timestamp").groupBy(*keys).agg(F.bit_or(minute_bit("timestamp")).alias("minutes"))


def _end(time: dt.datetime) -> Column:
    return F.struct(F.lit(time.date()).alias("Date"), F.lit(time.hour).alias("hour"), F.lit(1 << time.minute).cast("long").alias("minutes"))


def with_bookends(masks: DataFrame, start: dt.date, end_time: dt.datetime) -> DataFrame:
    """Masks to which every signal has added the two ends of the range."""
    ends = F.array(_end(dt.datetime.combine(start, dt.time())), _end(end_time))
    return masks.unionByName(masks.select("SignalID").distinct().select("SignalID", F.inline(ends)))


def _shifted(mask: Column, bits: int) -> Column:
    return F.shiftright(mask, -bits) if bits < 0 else F.shiftleft(mask, bits)


def _smeared(mask: Column, width: int, down: bool = False) -> Column:
    """Every set bit and the ``width - 1`` bits after it (or before it)."""
    done = 1
    while done < width:
        step = min(done, width - done)
        mask = mask.bitwiseOR(_shifted(mask, -step if down else step))
        done += step
    return mask


def _hour_columns(mask: Column) -> dict[str, Column]:
    """First and last minute of a mask, and the sum of the long steps between its minutes.

    Of a step of ``g`` minutes, ``g - GAP_MINUTES`` minutes are neither set nor among the ``GAP_MINUTES - 1`` after a set one; the
    last of them comes right before a set one.
    """
    lowest = mask.bitwiseAND(F.negative(mask))
    upto_last = _smeared(mask, 60, down=True)
    inside = upto_last.bitwiseAND(F.bitwise_not(lowest - 1))
    silent = F.bitwise_not(_smeared(mask, GAP_MINUTES)).bitwiseAND(inside)
    steps = F.bit_count(silent.bitwiseAND(F.shiftright(mask, 1)))
    return {
        "_first": F.col("hour") * 60 + F.bit_count(lowest - 1), "_last": F.col("hour") * 60 + F.bit_count(upto_last) - 1,
        "_inside": F.bit_count(silent) + steps * GAP_MINUTES,
    }


def _long(step: Column) -> Column:
    return F.when(step > GAP_MINUTES, step).otherwise(F.lit(0))


def _share_up(masks: DataFrame, keys: list[str], name: str, whole_days: bool) -> DataFrame:
    """Share of the day without long steps; a group has at most one mask an hour, 24 in all.

    Steps within an hour are found in the bits, those between hours from the ends of both.
    """
    day = Window.partitionBy(*keys).orderBy("hour")
    hours = masks.groupBy(*keys, "hour").agg(F.bit_or("minutes").alias("_minutes")).withColumns(_hour_columns(F.col("_minutes")))
    step = F.col("_first") - F.lag("_last").over(day)
    if whole_days:
        step = F.coalesce(step, F.col("_first"))
    gaps = hours.select(*keys, "_last", (F.col("_inside") + _long(step)).alias("_gap"))
    silent = F.sum("_gap")
    if whole_days:
        silent = silent + _long(F.lit(DAY_MINUTES - 1) - F.max("_last"))
    return gaps.groupBy(*keys).agg((1 - silent / F.lit(float(DAY_MINUTES))).alias(name))


def uptime_of(masks: DataFrame, start: dt.date | None = None, end_time: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Communications uptime from masks, per signal and date (``sig``) and over all signals (``all``).

    The range's ends count as heard for every signal. Without a range each day is taken on its own: its first
    and last minute count as heard for the signals of that day.
    """
    alone = start is None or end_time is None
    stamps = masks if alone else with_bookends(masks, start, end_time)
    return {
        "sig": _share_up(stamps, ["SignalID", "Date"], "uptime", alone),
        "all": _share_up(stamps, ["Date"], "uptime_all", alone),
    }
