"""Uptime, travel-time and camera rules on hand-made frames."""

import datetime as dt

from conftest import at, values
from pyspark.sql import functions as F

from corridor_metrics.context import RunContext
from corridor_metrics.operators import travel, uptime
from corridor_metrics.plans import camera_jobs, uptime_reports

DAY = dt.date(2024, 1, 1)


def stamps(spark, rows):
    return spark.createDataFrame([(s, at(t)) for s, t in rows], "signalid bigint, timestamp timestamp_ntz")


def test_gap_limit_is_strict(spark):
    df = stamps(spark, [(1, "2024-01-01 00:15:40"), (1, "2024-01-01 00:15:05"), (1, "2024-01-01 00:31:00"), (1, "2024-01-01 00:46:00")])
    out = uptime.comm_uptime(df, DAY, at("2024-01-01 00:50"))
    # gaps: 15, 16, 15, 4 minutes, of which only the 16 count
    assert values(out["sig"], "SignalID", "Date", "uptime") == [(1, DAY, 1 - 16 / 1440)]
    assert values(out["all"], "Date", "uptime_all") == [(DAY, 1 - 16 / 1440)]


def test_gap_over_midnight_does_not_count(spark):
    df = stamps(spark, [(1, "2024-01-01 00:00"), (1, "2024-01-01 23:00"), (1, "2024-01-02 02:00")])
    out = values(uptime.comm_uptime(df, DAY, at("2024-01-02 02:00"))["sig"], "Date", "uptime")
    assert out == [(DAY, 1 - 1380 / 1440), (dt.date(2024, 1, 2), 1.0)]


def test_silent_days(spark):
    df = stamps(spark, [(1, "2024-01-02 12:00"), (2, "2024-01-01 00:10")])
    out = values(uptime.comm_uptime(df, DAY, at("2024-01-04 23:59"))["sig"], "SignalID", "Date", "uptime")
    # bookends give rows on the first and last day; a silent day between has none
    assert [(s, d.day) for s, d, _ in out] == [(1, 1), (1, 2), (1, 4), (2, 1), (2, 4)]
    assert all(0 <= u <= 1 for *_, u in out)


def test_camera_spread(spark):
    rows = [("a", "2024-01-01 01:00:00", 10), ("a", "2024-01-01 02:00:00", 14), ("a", "2024-01-01 02:00:00", 14), ("b", "2024-01-01 01:00:00", 7)]
    raw = spark.createDataFrame(rows, "CameraID string, Datetime string, Size bigint").withColumn("date", F.lit(DAY))
    out = camera_jobs.camera_uptime(raw, dt.date(2024, 1, 2), encoders=True)
    assert values(out, "CameraID", "Size") == [("a", 8**0.5), ("b", 0.0)]
    assert camera_jobs.camera_uptime(raw, DAY, encoders=True).isEmpty()


def test_local_time_in_summer_and_winter(spark):
    raw = spark.createDataFrame(
        [("a", "Mon, 01 Jul 2024 12:00:00 GMT", 1), ("a", "Mon, 01 Jan 2024 12:00:00 GMT", 1)],
        "ID string, `Last-Modified` string, `Content-Length` bigint",
    ).withColumn("date", F.lit(DAY))
    assert values(camera_jobs.camera_log(raw), "Timestamp") == [(at("2024-01-01 07:00"),), (at("2024-07-01 08:00"),)]


def test_ped_repair_uses_good_days_of_the_month(spark):
    rows = [(1, 1, 2, dt.date(2024, 1, d), v) for d, v in ((1, 5), (2, 8))] + [(1, 1, 2, dt.date(2024, 2, 1), 100)]
    papd = spark.createDataFrame(rows, "SignalID int, Detector int, CallPhase int, Date date, papd bigint")
    pau = uptime.repair_ped_volumes(uptime.ped_uptime(papd, DAY, dt.date(2024, 2, 2)))
    out = {r["Date"]: (r["papd"], r["uptime"]) for r in pau.collect()}
    assert len(out) == 33
    assert out[dt.date(2024, 1, 3)] == (6.0, 0.0)
    assert out[dt.date(2024, 1, 2)] == (8.0, 1.0)
    assert out[dt.date(2024, 2, 2)] == (100.0, 0.0)


PRESSES = [(1, 1, 2, dt.date(2024, m, d), v) for m, d, v in ((1, 5, 3), (1, 6, 8), (1, 6, 9), (2, 1, 100), (2, 2, 0), (3, 9, 7))] + [
    (1, 2, 2, dt.date(2023, 12, 30), 4), (2, 1, 4, dt.date(2024, 2, 20), None), (2, 1, None, dt.date(2024, 1, 7), 5), (3, 1, 2, None, 5),
]


def test_ped_calendar_keeps_odd_rows(spark):
    papd = spark.createDataFrame(PRESSES, "SignalID int, Detector int, CallPhase int, Date date, papd bigint")
    start, end = dt.date(2024, 1, 4), dt.date(2024, 2, 20)
    pau = uptime.ped_uptime(papd, start, end)
    keys = ["SignalID", "Detector", "CallPhase"]
    # the same from a join with the calendar
    grid = papd.select(*keys).distinct().withColumn("Date", F.explode(F.sequence(F.lit(start), F.lit(end))))
    joined = grid.join(papd, [*keys, "Date"], "left").withColumns({"uptime": uptime.activity_rule(), "all": F.lit(1)})
    assert pau.columns == joined.columns and pau.dtypes == joined.dtypes
    assert values(pau, *pau.columns) == values(joined, *pau.columns)
    repaired, apart = uptime.repaired_ped_uptime(papd, start, end), uptime.repair_ped_volumes(joined)
    assert repaired.dtypes == apart.dtypes and values(repaired, *pau.columns) == values(apart, *pau.columns)
    assert (1, 1, 2, dt.date(2024, 1, 4), 6.0, 0.0, 1) in values(repaired, *pau.columns)
    strict = F.when(F.col("papd") > 5, F.lit(1.0)).otherwise(F.lit(0.5))
    assert values(uptime.repaired_ped_uptime(papd, start, end, strict), *pau.columns) == values(
        uptime.repair_ped_volumes(uptime.ped_uptime(papd, start, end, strict)), *pau.columns
    )


def test_every_day_of_a_button_is_neither_shuffled_nor_sorted(spark):
    counts = spark.createDataFrame([(1, 1, 2, DAY, 5)], "SignalID int, Detector int, CallPhase int, Date date, vol bigint")
    ctx = RunContext(DAY, dt.date(2024, 3, 15), dt.date(2024, 3, 16))
    plan = uptime_reports.ped_pushbutton_uptime(counts, ctx)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    filled = max(i for i, line in enumerate(lines) if "Generate" in line)
    assert not [line for line in lines[:filled] if any(x in line for x in ("Exchange", "Sort", "Window", "Join"))]


def test_saved_ped_marts_are_those_of_the_whole_history(spark, tmp_path):
    rows = [(s, 1, 2, dt.date(2023, 12, 1) + dt.timedelta(days=(7 * i + s) % 90), 1 + i % 3) for s in (1, 2, 3) for i in range(20)]
    counts = spark.createDataFrame(rows, "SignalID bigint, Detector int, CallPhase int, Date date, vol bigint")
    corridors = spark.createDataFrame(
        [(s, "g", "z", f"A{s % 2}", f"a{s}") for s in (1, 2)],
        "SignalID bigint, Zone_Group string, Zone string, Corridor string, Subcorridor string",
    )
    ctx = RunContext(dt.date(2024, 2, 1), dt.date(2024, 2, 27), dt.date(2024, 2, 28), root=str(tmp_path), wk_calcs_start_date=dt.date(2024, 1, 24))
    paths = uptime_reports.run_ped_pushbutton_uptime(counts, corridors, ctx)
    whole = uptime_reports.ped_pushbutton_marts(spark.read.parquet(f"{tmp_path}/pa_uptime"), corridors)
    for (level, per), mart in whole.items():
        (path,) = [p for p in paths if f"/{level}_{per}_pau/" in p]
        start = dt.date(2024, 1, 22) if per == "wk" else dt.date(2024, 2, 1)
        name = {"dy": "Date", "wk": "Week", "mo": "Month"}[per]
        expected = mart.where(F.col(name) >= F.lit(start)).withColumnRenamed("Week", "Date")
        saved = spark.read.parquet(path)
        assert values(saved, *expected.columns) == values(expected, *expected.columns) != []


def test_ped_history_reaches_back_six_months():
    ctx = RunContext(DAY, dt.date(2024, 3, 15), dt.date(2024, 3, 16))
    assert ctx.ped_history_start == dt.date(2023, 9, 1)


def test_uptime_marts_levels(spark):
    daily = spark.createDataFrame(
        [(1, DAY, 1.0), (1, DAY, 0.0), (1, dt.date(2024, 1, 8), 1.0), (2, DAY, 1.0)], "SignalID bigint, Date date, uptime double"
    )
    corridors = spark.createDataFrame(
        [(1, "g", "z", "A", "a1"), (2, "g", "z", "A", "a2")],
        "SignalID bigint, Zone_Group string, Zone string, Corridor string, Subcorridor string",
    )
    marts = uptime_reports.detector_uptime_marts(daily, corridors)
    assert sorted(marts) == sorted((lv, p) for lv in ("sig", "cor", "sub") for p in ("dy", "wk", "mo"))
    assert values(marts["cor", "dy"], "Date", "uptime") == [(DAY, 0.75), (dt.date(2024, 1, 8), 1.0)]
    assert values(marts["sig", "wk"], "SignalID", "Week", "uptime", "delta") == [
        (1, DAY, 0.5, None), (1, dt.date(2024, 1, 8), 1.0, 1.0), (2, DAY, 1.0, None),
    ]
    assert values(marts["sub", "mo"], "Zone_Group", "Zone", "Corridor", "uptime") == [("z", "A", "a1", 0.75), ("z", "A", "a2", 1.0)]


def test_relative_speed_index(spark):
    speeds = spark.createDataFrame([("A", float(v)) for v in range(11)] + [(None, 5.0)], "Corridor string, speed double")
    limits = spark.createDataFrame([("A", 10.0), ("B", 5.0)], "Corridor string, `Speed Limit` double")
    assert values(travel.relative_speed_index(speeds, limits, ["Corridor"]), "Corridor", "speed", "rsi") == [("A", 9.0, 0.9)]
    approx = travel.relative_speed_index(speeds, limits, ["Corridor"], approx=True).first()
    assert abs(approx["speed"] - 9.0) <= 1


def test_safety_index_counts_bins_outside_the_reference(spark):
    speeds = spark.createDataFrame([("A", 20.0), ("A", 20.0), ("A", 30.0), ("A", 99.0)], "Corridor string, speed double")
    reference = spark.createDataFrame([(20, 0.2), (30, 0.4)], "mph_bin int, pct double")
    ((_, pct),) = values(travel.serious_injury_pct(speeds, reference, ["Corridor"]), "Corridor", "overall_pct")
    assert abs(pct - (0.5 * 0.2 + 0.25 * 0.4)) < 1e-12
    assert pct <= 0.4


def test_reference_minutes_with_zero_speed(spark):
    readings = spark.createDataFrame(
        [("t1", at("2024-01-01 00:00"), 30.0, 60.0), ("t1", at("2024-01-01 00:01"), 30.0, 0.0), ("t9", at("2024-01-01 00:01"), 1.0, 1.0)],
        "tmc_code string, measurement_tstamp timestamp_ntz, speed double, reference_speed double",
    )
    segments = spark.createDataFrame([("t1", 2.0, "A", None), ("t9", 1.0, None, None)], "tmc string, miles double, Corridor string, Subcorridor string")
    out = travel.travel_times(readings, segments)
    assert values(out, "Corridor", "Subcorridor", "reference_minutes") == [("A", "None", 2.0), ("A", "None", None)]
