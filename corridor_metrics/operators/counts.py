"""Detector counts, their quality flags and the volumes built from them.

Counts hold one row per detector and period. All windows here run inside one
detector and day, or one phase and period: both are bounded by the clock and the
hardware, not by the length of the history.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.context import COUNT_THRESHOLDS
from corridor_metrics.functions.columns import dow_monday0, dow_monday1, floor_to_unit, iso_week
from corridor_metrics.functions.measures import drop_null_keys, ratio, total
from corridor_metrics.operators.filters import day_gate, mainline, with_timeperiod
from corridor_metrics.operators.scale import checked_join, lag_over_frame, row_numbers

VEHICLE_DETECTOR_ON = 82
NO_PHASE = -1


def period_counts(events: DataFrame, units: str = "hours", event_code: int = VEHICLE_DETECTOR_ON) -> DataFrame:
    """Events of a code per period, signal and detector."""
    hits = events.where(F.col("eventcode") == event_code)
    return (
        drop_null_keys(hits, "timestamp", "signalid", "eventparam")
        .withColumn("timeperiod", floor_to_unit("timestamp", units))
        .groupBy("timeperiod", "signalid", "eventparam")
        .agg(F.count("*").alias("vol"))
    )


def detector_counts(
    events: DataFrame, det_config: DataFrame, units: str = "hours",
    event_code: int = VEHICLE_DETECTOR_ON, twr_only: bool = False,
) -> DataFrame:
    """Actuations per period, signal and detector, with the phase of the detector."""
    vol = period_counts(day_gate(events, "timestamp", twr_only), units, event_code)
    return with_phase(vol, det_config).select("signalid", "timeperiod", "eventparam", "CallPhase", "vol")


def with_phase(counts: DataFrame, det_config: DataFrame) -> DataFrame:
    """Add ``CallPhase``; detectors without configuration keep NULL."""
    phases = det_config.select("signalid", "eventparam", "CallPhase")
    return checked_join(counts, phases, ["signalid", "eventparam"], "left")


def signal_event_counts(events: DataFrame, interval: str = "hour") -> DataFrame:
    """Detection events per signal and period, the stand-in for queue spillback."""
    return (
        drop_null_keys(events, "signalid", "timestamp")
        .groupBy(F.col("signalid").alias("SignalID"), floor_to_unit("timestamp", interval).alias("Timeperiod"))
        .agg(F.count("timestamp").alias("queue_spillback_metric"))
    )


def with_flatline(counts: DataFrame, history: bool = True) -> DataFrame:
    """Add ``delta_vol`` and ``flatlined`` per signal, phase and detector.

    ``flatlined`` counts the rows so far that equal their predecessor; it never
    resets, and is NULL without a phase. Each detector-day is scanned on its own.
    A frame with one row per detector-day carries the last volume and the count
    over midnight, so the history of a detector is never in one task. Both use the
    same shuffle of the rows: keys are complete and the phase travels as ``_phase``.
    Without ``history`` a day starts anew: its first row has no ``delta_vol`` and the count begins at 0.
    """
    entity = ["signalid", "_phase", "eventparam"]
    keys = [*entity, "_day"]
    day = Window.partitionBy(*keys).orderBy("timeperiod")
    so_far = day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = Window.partitionBy(*entity).orderBy("_day")
    past = days.rowsBetween(Window.unboundedPreceding, -1)

    keyed = counts.withColumns(
        {"_phase": F.coalesce(F.col("CallPhase").cast("long"), F.lit(NO_PHASE)), "_day": F.to_date("timeperiod")}
    )
    rows = (
        drop_null_keys(keyed.drop("CallPhase"), *keys)
        .withColumn("_prev", F.lag("vol").over(day))
        .withColumn("_same", F.coalesce(F.col("vol") == F.col("_prev"), F.lit(False)).cast("long"))
    )
    if not history:
        return (
            rows.withColumn("CallPhase", F.when(F.col("_phase") != NO_PHASE, F.col("_phase")).cast(counts.schema["CallPhase"].dataType))
            .withColumn("delta_vol", F.col("vol") - F.col("_prev"))
            .withColumn("flatlined", F.when(F.col("_phase") != NO_PHASE, F.sum("_same").over(so_far)))
            .select(*counts.columns, "delta_vol", "flatlined")
        )
    carry = (
        rows.groupBy(*keys)
        .agg(
            F.min_by("vol", "timeperiod").alias("_opening"),
            F.max_by("vol", "timeperiod").alias("_closing"),
            F.sum("_same").alias("_repeats"),
        )
        .withColumn("_yesterday", F.lag("_closing").over(days))
        .withColumn("_joins", F.coalesce(F.col("_opening") == F.col("_yesterday"), F.lit(False)).cast("long"))
        .withColumn("_base", F.coalesce(F.sum(F.col("_repeats") + F.col("_joins")).over(past), F.lit(0)))
        .select(*keys, "_yesterday", (F.col("_base") + F.col("_joins")).alias("_base"))
    )
    phase_type = counts.schema["CallPhase"].dataType
    known = F.col("_phase") != NO_PHASE
    return (
        rows.withColumn("_first", F.row_number().over(day) == 1)
        .withColumn("_repeats", F.sum("_same").over(so_far))
        .join(carry, keys, "left")
        .withColumn("CallPhase", F.when(known, F.col("_phase")).cast(phase_type))
        .withColumn("delta_vol", F.col("vol") - F.when(F.col("_first"), F.col("_yesterday")).otherwise(F.col("_prev")))
        .withColumn("flatlined", F.when(known, F.col("_repeats") + F.col("_base")))
        .select(*counts.columns, "delta_vol", "flatlined")
    )


def frame_delta(counts: DataFrame, name: str = "delta_vol") -> DataFrame:
    """Volume difference to the preceding row of the frame sorted by period, signal, detector."""
    lagged = lag_over_frame(counts, ["timeperiod", "signalid", "eventparam"], "vol", "_prev")
    return lagged.withColumn(name, F.col("vol") - F.col("_prev")).drop("_prev")


def filtered_counts(
    counts: DataFrame, interval: str = "1 hour", delta_scope: str = "detector",
    thresholds: Mapping[str, Mapping[str, float]] = COUNT_THRESHOLDS, history: bool = True,
) -> DataFrame:
    """Counts with the flags flat, too high and jumping; ``Good_Day`` when none is set.

    ``delta_scope="frame"`` compares neighbouring rows of the sorted frame instead
    of successive periods of a detector. Without ``history`` every day is judged on its own.
    """
    if interval not in thresholds:
        raise ValueError(f"no thresholds for the interval {interval!r}; there are {sorted(thresholds)}")
    limit = thresholds[interval]
    flagged = with_flatline(counts, history)
    if delta_scope == "frame":
        flagged = frame_delta(flagged.drop("delta_vol"))

    def over(value: Column, bound: float) -> Column:
        return F.coalesce(value > bound, F.lit(False))

    flagged = flagged.withColumns(
        {
            "flat_flag": over(F.col("flatlined"), limit["max_flat"]),
            "maxvol_flag": over(F.col("vol"), limit["max_volume"]),
            "mad_flag": over(F.abs("delta_vol"), limit["max_abs_delta"]),
        }
    )
    return flagged.withColumn("Good_Day", ~(F.col("flat_flag") | F.col("maxvol_flag") | F.col("mad_flag"))).select(
        *counts.columns, "delta_vol", "flatlined", "flat_flag", "maxvol_flag", "mad_flag", "Good_Day"
    )


def adjusted_counts(counts: DataFrame, mode: str = "as_coded") -> DataFrame:
    """Fill missing volumes from the phase mean and the detector's contribution.

    ``as_coded``: the contribution is the row's own volume over the detector total,
    so it is missing exactly where the volume is. ``share``: it is the detector's
    part of the phase total, which does fill the gaps.
    """
    if mode not in ("as_coded", "share"):
        raise ValueError("mode must be 'as_coded' or 'share'")
    detector = ["signalid", "CallPhase", "eventparam"]
    phase = Window.partitionBy("signalid", "CallPhase")
    totals = (
        drop_null_keys(counts, *detector)
        .groupBy(*detector)
        .agg(total("vol").cast("double").alias("_det"))
        .withColumn("_phase", F.sum("_det").over(phase))
    )
    slot = Window.partitionBy("signalid", "CallPhase", "timeperiod")
    contribution = F.col("vol") if mode == "as_coded" else F.col("_det")
    base = F.col("_det") if mode == "as_coded" else F.col("_phase")
    return (
        checked_join(counts, totals, detector, "left")
        .withColumn("Ph_Contr", ratio(contribution.cast("double"), base))
        .withColumn("mvol", F.when(F.col("CallPhase").isNotNull(), F.avg("vol").over(slot)))
        .withColumn("vol", F.coalesce(F.col("vol").cast("double"), F.col("mvol") * F.col("Ph_Contr")))
        .select(*counts.columns, "Ph_Contr", "mvol")
    )


def vehicles_per_period(counts: DataFrame, interval: str = "1 hour", mainline_only: bool = True) -> DataFrame:
    """Volume per signal and period with ISO week and Monday=1 weekday."""
    out = (
        drop_null_keys(with_timeperiod(mainline(counts, mainline_only)), "SignalID", "Timeperiod")
        .groupBy("SignalID", "Timeperiod")
        .agg(total("vol").alias("vph"))
        .select("SignalID", iso_week("Timeperiod").alias("Week"), dow_monday1("Timeperiod").alias("DOW"), "Timeperiod", "vph")
    )
    return out.withColumnRenamed("Timeperiod", "Hour") if interval == "1 hour" else out


def vehicles_per_day(counts: DataFrame, mainline_only: bool = True) -> DataFrame:
    return (
        drop_null_keys(mainline(counts, mainline_only), "SignalID", "CallPhase", "Timeperiod")
        .groupBy("SignalID", "CallPhase", F.to_date("Timeperiod").alias("Date"))
        .agg(total("vol").alias("vpd"))
    )


def throughput(counts: DataFrame, dedupe: bool = False) -> DataFrame:
    """95th percentile of the 15-minute volumes of a signal-day, as an hourly rate.

    A period weighs as often as it has detector rows; ``dedupe`` weighs every
    period once. Periods are summed first, so the percentile sees at most one row
    per period of the day, with the row count as its frequency.
    """
    slots = (
        drop_null_keys(counts, "SignalID", "Timeperiod")
        .groupBy("SignalID", F.to_date("Timeperiod").alias("Date"), "Timeperiod")
        .agg(total("vol").cast("double").alias("_vol"), F.count("*").alias("_n"))
    )
    weight = F.lit(1).cast("long") if dedupe else F.col("_n")
    return slots.groupBy("SignalID", "Date").agg((F.percentile("_vol", 0.95, weight) * 4).alias("vph"))


def detector_uptime(filtered: DataFrame) -> DataFrame:
    """Daily ``Good_Day`` (1/0) of each detector on a gapless calendar; missing days are 0."""
    days = filtered.select("SignalID", "Detector", "Date", F.col("Good_Day").cast("int").alias("Good_Day")).distinct()
    span = days.agg(F.struct(F.min("Date").alias("first"), F.max("Date").alias("last"))).scalar()
    grid = (
        drop_null_keys(days, "SignalID", "Detector")
        .select("SignalID", "Detector")
        .distinct()
        .withColumn("Date", F.explode(F.sequence(span["first"], span["last"])))
    )
    return grid.join(days, ["SignalID", "Detector", "Date"], "left").withColumn(
        "Good_Day", F.coalesce("Good_Day", F.lit(0))
    )


def bad_detectors(filtered: DataFrame) -> DataFrame:
    return detector_uptime(filtered).where(F.col("Good_Day") == 0)


def daily_ped_activations(counts: DataFrame) -> DataFrame:
    """Button presses per day; the weekday here counts from Monday=0."""
    keys = ["SignalID", "Date", "Detector", "CallPhase"]
    return (
        drop_null_keys(counts, *keys)
        .groupBy(*keys)
        .agg(total("vol").alias("papd"))
        .withColumns({"DOW": dow_monday0("Date"), "Week": iso_week("Date")})
        .select("SignalID", "Date", "DOW", "Week", "Detector", "CallPhase", "papd")
    )


def signal_batches(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """Assign the sorted signals to batches of about ``rows`` records each."""
    per_signal = drop_null_keys(df, "SignalID").groupBy("SignalID").agg(F.count("*").alias("records"))
    sizes = per_signal.agg(F.sum("records").alias("n"), F.count("*").alias("s")).first()
    if not sizes["s"]:
        return per_signal.withColumn("batch", F.lit(None).cast("long")).select("SignalID", "records", "batch")
    length = max(1, round(rows / (sizes["n"] / sizes["s"])))
    return (
        row_numbers(per_signal, "SignalID", "_n")
        .withColumn("batch", F.floor((F.col("_n") - 1) / length))
        .select("SignalID", "records", "batch")
    )
