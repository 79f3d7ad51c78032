"""Counts, flags, volumes and waiting times on hand-made frames."""

import datetime as dt
import random

import pytest
from conftest import at, values
from pyspark.sql import functions as F

from corridor_metrics.operators import counts as ops
from corridor_metrics.operators import delays, filters
from corridor_metrics.plans import counts_jobs, signal_detail

EVENTS = "timestamp timestamp_ntz, signalid bigint, eventcode int, eventparam int"
COUNTS = "signalid bigint, timeperiod timestamp_ntz, eventparam bigint, CallPhase int, vol bigint"


def events(spark, rows):
    return spark.createDataFrame([(at(t), s, c, p) for t, s, c, p in rows], EVENTS)


def series(spark, vols, signal=1, det=1, phase=2, start="2024-01-01 00:00", minutes=60):
    first = at(start)
    rows = [(signal, first + dt.timedelta(minutes=minutes * i), det, phase, v) for i, v in enumerate(vols)]
    return spark.createDataFrame(rows, COUNTS)


def test_detector_counts(spark):
    df = events(spark, [
        ("2024-01-01 00:14:59.999", 1, 82, 5), ("2024-01-01 00:15:00", 1, 82, 5), ("2024-01-01 00:15:01", 1, 82, 5),
        ("2024-01-01 00:16:00", 1, 81, 5), ("2024-01-01 01:00:00", 1, 82, 9), ("2024-01-02 01:00:00", 1, 82, None),
    ])
    config = spark.createDataFrame([(1, 5, 2)], "signalid bigint, eventparam int, CallPhase int")
    assert values(ops.detector_counts(df, config, "15min"), "timeperiod", "eventparam", "CallPhase", "vol") == [
        (at("2024-01-01 00:00"), 5, 2, 1), (at("2024-01-01 00:15"), 5, 2, 2), (at("2024-01-01 01:00"), 9, None, 1),
    ]
    assert values(ops.detector_counts(df, config, "hours"), "vol") == [(1,), (3,)]
    # 1 January 2024 is a Monday
    assert ops.detector_counts(df, config, "hours", twr_only=True).isEmpty()
    with pytest.raises(ValueError):
        ops.detector_counts(df, config, "days")


def test_flat_flag_needs_more_than_five_repeats(spark):
    out = ops.filtered_counts(series(spark, [7] * 7)).orderBy("timeperiod").collect()
    assert [r["flatlined"] for r in out] == [0, 1, 2, 3, 4, 5, 6]
    assert [r["flat_flag"] for r in out] == [False] * 6 + [True]
    assert [r["Good_Day"] for r in out] == [True] * 6 + [False]


def test_flatline_runs_over_midnight_and_never_resets(spark):
    vols = [5, 5, 5, 5, 9, 5, 5, 5]
    out = ops.with_flatline(series(spark, vols, start="2024-01-01 21:00")).orderBy("timeperiod").collect()
    assert [r["flatlined"] for r in out] == [0, 1, 2, 3, 3, 3, 4, 5]
    assert [r["delta_vol"] for r in out] == [None, 0, 0, 0, 4, -4, 0, 0]


def test_flatline_over_days_without_rows(spark):
    df = series(spark, [5], start="2024-01-01 21:00").union(series(spark, [5, 5], start="2024-01-09 03:00"))
    out = ops.with_flatline(df).orderBy("timeperiod").collect()
    assert [r["flatlined"] for r in out] == [0, 1, 2]


def test_thresholds_are_strict(spark):
    out = ops.filtered_counts(series(spark, [1200, 1201, 1001, 800, 1000])).orderBy("timeperiod").collect()
    assert [r["maxvol_flag"] for r in out] == [False, True, False, False, False]
    assert [r["mad_flag"] for r in out] == [False, False, False, True, False]
    with pytest.raises(ValueError):
        ops.filtered_counts(series(spark, [1]), "5 min")


def test_null_phase_and_null_volume_are_not_flagged(spark):
    out = ops.filtered_counts(series(spark, [3, 3, None, 3], phase=None)).orderBy("timeperiod").collect()
    assert [r["flatlined"] for r in out] == [None] * 4
    assert [r["CallPhase"] for r in out] == [None] * 4
    assert all(r["Good_Day"] for r in out)


def test_frame_delta_compares_neighbouring_rows(spark):
    df = series(spark, [10, 40], det=1).union(series(spark, [500, 70], det=2))
    out = ops.filtered_counts(df, delta_scope="frame").orderBy("timeperiod", "eventparam").collect()
    assert [r["delta_vol"] for r in out] == [None, 490, -460, 30]
    assert [r["mad_flag"] for r in out] == [False, True, True, False]


def test_adjusted_counts_modes(spark):
    df = series(spark, [30, 30], det=1).union(series(spark, [10, None], det=2)).union(series(spark, [4], det=3, phase=None))
    as_coded = values(ops.adjusted_counts(df), "eventparam", "vol", "mvol")
    assert as_coded == [(1, 30.0, 20.0), (1, 30.0, 30.0), (2, 10.0, 20.0), (2, None, 30.0), (3, 4.0, None)]
    share = values(ops.adjusted_counts(df, "share").where("eventparam = 2"), "vol", "Ph_Contr")
    assert share == [(10.0, 10 / 70), (30.0 * (10 / 70), 10 / 70)]
    with pytest.raises(ValueError):
        ops.adjusted_counts(df, "other")


def report(df):
    return filters.report_names(df)


def test_volumes(spark):
    df = report(series(spark, [1, 2], phase=2).union(series(spark, [10, 20], det=2, phase=6)).union(series(spark, [5], det=3, phase=4)))
    hour = ops.vehicles_per_period(df)
    assert values(hour, "SignalID", "Week", "DOW", "vph") == [(1, 1, 1, 11), (1, 1, 1, 22)]
    assert "Hour" in hour.columns
    assert "Timeperiod" in ops.vehicles_per_period(df, "15 min").columns
    assert values(ops.vehicles_per_period(df, mainline_only=False), "vph") == [(16,), (22,)]
    assert values(ops.vehicles_per_day(df), "CallPhase", "Date", "vpd") == [
        (2, dt.date(2024, 1, 1), 3), (6, dt.date(2024, 1, 1), 30),
    ]


def test_throughput_weighs_by_detector_rows(spark):
    df = report(series(spark, [1, 9], det=1, minutes=15).union(series(spark, [1], det=2, minutes=15)))
    # rows carry the period sums 2, 2, 9
    assert values(ops.throughput(df), "vph") == [((2 + 0.9 * 7) * 4,)]
    assert values(ops.throughput(df, dedupe=True), "vph") == [((2 + 0.95 * 7) * 4,)]


def test_detector_calendar(spark):
    df = spark.createDataFrame(
        [(1, 1, dt.date(2024, 1, 1), True), (1, 1, dt.date(2024, 1, 1), False), (1, 1, dt.date(2024, 1, 3), True), (2, 1, dt.date(2024, 1, 2), True)],
        "SignalID int, Detector int, Date date, Good_Day boolean",
    )
    out = values(ops.detector_uptime(df), "SignalID", "Date", "Good_Day")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    assert out == sorted(
        [(1, days[0], 0), (1, days[0], 1), (1, days[1], 0), (1, days[2], 1), (2, days[0], 0), (2, days[1], 1), (2, days[2], 0)], key=repr
    )
    assert ops.bad_detectors(df).count() == 4


def test_signal_batches(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("SignalID"))
    out = values(ops.signal_batches(df, 30), "SignalID", "batch")
    assert [b for _, b in out] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]
    assert ops.signal_batches(df.limit(0)).isEmpty()


def test_merge_matches_null_phases(spark):
    cols = "SignalID bigint, Date date, Timeperiod timestamp_ntz, Detector bigint, CallPhase int"
    day = dt.date(2024, 1, 1)
    base = [(1, day, at("2024-01-01 05:00"), 1, None), (1, day, at("2024-01-01 06:00"), 2, 4)]
    raw = spark.createDataFrame([(*r, 5) for r in base], cols + ", vol bigint")
    good = spark.createDataFrame([(*base[0], False)], cols + ", Good_Day boolean")
    adjusted = spark.createDataFrame([(*r, 7.0) for r in base], cols + ", vol double")
    merged = signal_detail.masked(signal_detail.merged_counts(raw, good, adjusted))
    assert values(merged, "Detector", "vol_rc", "Good_Day", "bad_day", "vol_ac", "Hour") == [
        (1, 5, False, True, 7, 5), (2, 5, None, False, None, 6),
    ]
    other = good.withColumn("Date", F.date_add("Date", 1))
    assert signal_detail.signal_details(raw, other, adjusted).isEmpty()
    nested = signal_detail.signal_details(raw, good, adjusted).collect()
    assert [r["Detector"] for r in nested[0]["data"]] == [1, 2]


def test_next_event_looks_past_empty_hours(spark):
    df = events(spark, [
        ("2024-01-01 00:10:00", 1, 45, 2), ("2024-01-01 00:10:00", 1, 45, 2), ("2024-01-01 03:00:10", 1, 21, 2),
        ("2024-01-01 03:00:20", 1, 45, 2), ("2024-01-01 03:00:50", 1, 21, 2), ("2024-01-01 04:00:00", 1, 45, 2),
        ("2024-01-01 04:00:00", 1, 21, 3),
    ])
    out = values(delays.next_event(df, 45, 21, ["signalid", "eventparam"]), "start", "end", "n")
    assert out == sorted([
        (at("2024-01-01 00:10:00"), at("2024-01-01 03:00:10"), 2), (at("2024-01-01 03:00:20"), at("2024-01-01 03:00:50"), 1),
        (at("2024-01-01 04:00:00"), None, 1),
    ], key=repr)
    assert values(delays.ped_delay(df), "SignalID", "ped_delay") == [(1, (2 * 10210 + 30) / 3)]


def test_split_failure_needs_both_occupancies(spark):
    cycle = events(spark, [
        ("2024-01-01 00:00:00", 1, 1, 2), ("2024-01-01 00:00:30", 1, 10, 2), ("2024-01-01 00:02:00", 1, 1, 2),
        ("2024-01-01 00:02:30", 1, 10, 2),
    ]).withColumnRenamed("eventparam", "CallPhase").withColumn("CallPhase", F.col("CallPhase").cast("long"))
    detections = events(spark, [
        ("2024-01-01 00:00:02", 1, 82, 9), ("2024-01-01 00:00:34", 1, 81, 9),  # 28 of 30 s green, 4 of 5 s red
        ("2024-01-01 00:02:00", 1, 82, 9), ("2024-01-01 00:02:31", 1, 81, 9),  # 30 of 30 s green, 1 of 5 s red
    ])
    config = spark.createDataFrame([(1, 9, 2)], "signalid bigint, eventparam int, CallPhase int")
    out = delays.split_failures(cycle, detections, config, 60)
    assert values(out, "SignalID", "CallPhase", "cycles", "split_failures") == [(1, 2, 2, 1)]
    coarse = delays.split_failures(cycle, detections, config, 60, slot_minutes=60)
    assert values(coarse, "split_failures") == [(1,)]
    busy = events(spark, [("2023-12-31 22:00:00", 1, 82, 9), ("2024-01-01 00:02:10", 1, 81, 9), ("2024-01-01 00:02:12", 1, 82, 9)])
    held = delays.split_failures(cycle, busy, config, 60)  # over an hour on; the last "on" has no end yet
    assert values(held, "cycles", "split_failures") == [(2, 1)]
    to_end = delays.split_failures(cycle, busy, config, 60, until=dt.datetime(2024, 1, 1, 1))
    assert values(to_end, "cycles", "split_failures") == [(2, 2)]


def test_month_range():
    assert counts_jobs.month_range(dt.date(2024, 2, 1), dt.date(2024, 2, 10)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 10))
    assert counts_jobs.month_range(dt.date(2024, 2, 1), dt.date(2024, 5, 1)) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_overlaps_of_intervals_of_any_length(spark):
    rng = random.Random(7)
    minute = delays.MINUTE

    def intervals(n, longest):
        out = []
        for _ in range(n):
            start = rng.randrange(0, 3000 * minute)
            out.append((rng.randrange(2), start, start + rng.choice([0, 1, minute, rng.randrange(minute), rng.randrange(longest * minute), 2 ** rng.randrange(9) * minute])))
        return list(dict.fromkeys(out))

    left, right = intervals(150, 20), intervals(150, 1500)
    a = spark.createDataFrame(left, "k int, a long, b long")
    b = spark.createDataFrame(right, "k int, c long, d long")
    for x, y, ends in ((a, b, (("a", "b"), ("c", "d"))), (b, a, (("c", "d"), ("a", "b")))):
        got = delays.overlaps(x, y, ["k"], *ends, minute).groupBy("k", "a", "b", "c", "d").agg(F.sum("shared").alias("s")).where("s > 0")
        want = sorted((k, s, e, t, f, min(e, f) - max(s, t)) for k, s, e in left for j, t, f in right if j == k and min(e, f) > max(s, t))
        assert sorted(tuple(r) for r in got.select("k", "a", "b", "c", "d", "s").collect()) == want


def test_a_long_interval_is_in_few_rows(spark):
    minute = delays.MINUTE
    month = spark.createDataFrame([(1, 17, 17 + 30 * 1440 * minute)], "k int, a long, b long").withColumn("_own", delays.own_level(F.col("a"), F.col("b"), minute))
    levels = F.array(*[F.lit(i) for i in range(24)])
    pieces = delays._placed(month.withColumn("_theirs", levels), "a", "b", minute, 1, 2, "_theirs")
    assert pieces.count() <= 3 * 24 and pieces.where("_role = 0").count() <= 2
    short = spark.createDataFrame([(1, 17, 17 + 20)], "k int, a long, b long").withColumn("_own", delays.own_level(F.col("a"), F.col("b"), minute))
    assert delays._placed(short.withColumn("_theirs", F.array(F.lit(0))), "a", "b", minute, 1, 2, "_theirs").count() == 1
