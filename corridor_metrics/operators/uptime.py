"""Communications, camera, detector and ped-button uptime."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.functions.measures import drop_null_keys
from corridor_metrics.operators.activity import GAP_MINUTES, minute_masks, uptime_of


def gap_spans(stamps: DataFrame, keys: list[str]) -> DataFrame:
    """Minutes since the preceding stamp of the same keys, 0 unless above the gap limit.

    ``keys`` include the date, so the time of day is enough.
    """
    seconds = F.hour("Timestamp") * 3600 + F.minute("Timestamp") * 60 + F.date_part(F.lit("SECOND"), "Timestamp").cast("double")
    w = Window.partitionBy(*keys).orderBy("Timestamp")
    gap = (seconds - F.lag(seconds).over(w)) / 60
    return stamps.withColumn("span", gap).withColumn(
        "span", F.when(F.col("span") > GAP_MINUTES, F.col("span")).otherwise(F.lit(0.0))
    )


def comm_uptime(events: DataFrame, start: dt.date, end_time: dt.datetime) -> dict[str, DataFrame]:
    """Share of the day without reporting gaps of more than 15 minutes.

    ``sig``: per signal and date. ``all``: per date, over the stamps of all signals.
    """
    return uptime_of(minute_masks(events), start, end_time)


def camera_size_spread(images: DataFrame) -> DataFrame:
    """Sample deviation of the image size per camera and day; above 0 means a live picture."""
    return (
        drop_null_keys(images, "CameraID", "Date")
        .select("CameraID", "Timestamp", "Size", "Date")
        .distinct()
        .groupBy("CameraID", "Date")
        .agg(F.coalesce(F.stddev_samp("Size"), F.lit(0.0)).alias("Size"))
    )


def daily_detector_uptime(df: DataFrame) -> DataFrame:
    """Mean detector uptime per signal and day."""
    return drop_null_keys(df, "SignalID", "Date").groupBy("SignalID", "Date").agg(F.avg("uptime").alias("uptime"))


def activity_rule() -> Column:
    """A button counts as up on days with at least one press."""
    return F.when(F.coalesce(F.col("papd"), F.lit(0)) > 0, F.lit(1.0)).otherwise(F.lit(0.0))


BUTTON = ["SignalID", "Detector", "CallPhase"]


def _month(date: Column | str) -> Column:
    return F.trunc(date, "month")


def _button_months(papd: DataFrame, start: dt.date, end: dt.date, good: Column) -> DataFrame:
    """One row per button and month of the range, with ``_days``, the list of its days with presses, and the mean of ``good`` over these days.

    A signal's buttons are in one partition, which the calendar does not change. Incomplete keys have no days.
    """
    complete = reduce(and_, [F.col(k).isNotNull() for k in BUTTON])
    known = F.when(complete & F.col("Date").between(F.lit(start), F.lit(end)), F.struct("Date", "papd"))
    months = (
        papd.select(*BUTTON, known.alias("_day"))
        .select(*BUTTON, "_day.*")
        .withColumns({"_good": good, "_month": _month("Date")})
        .repartition("SignalID")
        .groupBy(*BUTTON, "_month")
        .agg(F.collect_list(F.when(F.col("Date").isNotNull(), F.struct("Date", "papd"))).alias("_days"), F.avg("_good").alias("_mean"))
    )
    found = F.collect_list(F.when(F.col("_month").isNotNull(), F.struct("_month", "_days", "_mean")))
    buttons = months.groupBy(*BUTTON).agg(found.alias("_found"))
    every = F.sequence(_month(F.lit(start)), F.lit(end), F.expr("interval 1 month"))
    empty = F.array_except(every, F.transform("_found", lambda m: m["_month"]))
    nothing = [F.lit(None).cast(months.schema[c].dataType).alias(c) for c in ("_days", "_mean")]
    both = F.concat("_found", F.transform(empty, lambda m: F.struct(m.alias("_month"), *nothing)))
    return buttons.select(*BUTTON, F.inline(both))


def _with_calendar(months: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """A row per button and day of the range, with its presses or NULL; at most 31 days are looked through for each month."""
    first, last = F.greatest(F.col("_month"), F.lit(start)), F.least(F.last_day("_month"), F.lit(end))
    days = F.coalesce("_days", F.array().cast(months.schema["_days"].dataType))
    silent = F.array_except(F.sequence(first, last), F.transform(days, lambda d: d["Date"]))
    presses = months.schema["_days"].dataType.elementType["papd"].dataType
    both = F.concat(days, F.transform(silent, lambda d: F.struct(d.alias("Date"), F.lit(None).cast(presses).alias("papd"))))
    return months.select(*BUTTON, F.inline(both), "_mean")


def ped_uptime(papd: DataFrame, start: dt.date, end: dt.date, rule: Column | None = None) -> DataFrame:
    """Uptime of every ped button on every day of the range; weight ``all`` is 1."""
    days = _with_calendar(_button_months(papd, start, end, F.lit(None).cast("double")), start, end).drop("_mean")
    return days.withColumns({"uptime": activity_rule() if rule is None else rule, "all": F.lit(1)})


def repaired_ped_uptime(papd: DataFrame, start: dt.date, end: dt.date, rule: Column | None = None) -> DataFrame:
    """``repair_ped_volumes`` of ``ped_uptime``, without a shuffle or sort of every button's every day.

    Only days with presses can be good ones, so the means are taken before the calendar is filled in.
    ``rule`` reads the columns of a button and day, and gives the same value each time.
    """
    rule = activity_rule() if rule is None else rule
    good = F.when(rule == 1, F.col("papd"))
    days = _with_calendar(_button_months(papd, start, end, good), start, end).withColumns({"uptime": rule, "all": F.lit(1)})
    return days.withColumn("papd", F.coalesce(good.cast("double"), F.floor("_mean").cast("double"))).drop("_mean")


def repair_ped_volumes(pau: DataFrame) -> DataFrame:
    """Replace the volume of days that are not fully up by the floored mean of the month's good days.

    The window spans one button and month, at most 31 rows. ``repaired_ped_uptime`` does this for a whole history.
    """
    month = Window.partitionBy("SignalID", "Detector", "CallPhase", F.year("Date"), F.month("Date"))
    good = F.when(F.col("uptime") == 1, F.col("papd"))
    return pau.withColumn("_good", good).withColumn(
        "papd", F.coalesce(F.col("_good").cast("double"), F.floor(F.avg("_good").over(month)).cast("double"))
    ).drop("_good")
