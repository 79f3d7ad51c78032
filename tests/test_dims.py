"""Dimensions, configurations, alerts, mart reads and dates."""

import datetime as dt

import pytest
from conftest import at, values
from pyspark.sql import functions as F

from corridor_metrics.functions import columns as fn
from corridor_metrics.functions import dates
from corridor_metrics.operators import alerts, dims, filters, marts, scale
from corridor_metrics.sources import sinks

TODAY = dt.date(2024, 3, 10)


def corridor_rows(spark, rows):
    base = {f.name: None for f in dims.CORRIDOR_SCHEMA.fields}
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], dims.CORRIDOR_SCHEMA)


def test_corridor_dimension(spark):
    common = {"District": "Zone 1", "Contract": "RTOP1", "Corridor": " A ", "Include": True, "Main Street Name": " M ", "Side Street Name": "S"}
    raw = corridor_rows(spark, [
        {**common, "SignalID": 1.0, "Milepost": 1.0},
        {**common, "SignalID": 1.0, "Milepost": 2.0, "Modified": at("2020-01-01")},
        {**common, "SignalID": 2.0, "Include": False},
        {**common, "SignalID": 0.0},
        {**common, "SignalID": 3.0, "Corridor": None},
        {**common, "SignalID": 4.0, "Contract": "Other", "District": "Zone 9"},
    ])
    out = dims.corridor_dimension(raw)
    assert values(out, "SignalID", "Corridor", "Milepost", "Name", "Description") == [
        (1, "A", 2.0, "M @ S", "1: M @ S"), (4, "A", None, "M @ S", "4: M @ S"),
    ]
    assert values(dims.corridor_dimension(raw, mark_only=True), "SignalID") == [(1,)]
    assert dims.corridor_dimension(raw, filter_signals=False).count() == 4
    assert {"Zone_Group", "Zone"} <= set(dims.report_corridors(out).columns)


def test_corridor_conflicts(spark):
    cols = "District string, Contract string, Corridor string"
    clean = spark.createDataFrame([("d", "c", "A"), ("d", "c", "A"), ("d", "c", "B")], cols)
    assert dims.corridors_are_clean(clean)
    zones = clean.union(spark.createDataFrame([("e", "c", "A")], cols))
    assert not dims.corridors_are_clean(zones)
    assert dims.corridor_conflicts(zones)["zones"].count() == 2
    case = clean.union(spark.createDataFrame([("d", "c", "b")], cols))
    assert values(dims.corridor_conflicts(case)["case"], "Corridor") == [("B",), ("b",)]


def test_configs(spark):
    rows = [(dt.date(2024, 1, 1), 1, 1, None, 0), (dt.date(2024, 1, 1), 1, 1, 6, 1), (dt.date(2024, 1, 1), 1, 1, 2, 2), (dt.date(2024, 1, 3), 2, 1, 4, 0)]
    config = spark.createDataFrame(rows, "date date, SignalID int, Detector int, CallPhase int, line int")
    assert values(dims.det_config_on(config, dt.date(2024, 1, 1), "line"), "CallPhase") == [(6,)]
    with pytest.raises(ValueError):
        dims.det_config_on(config, dt.date(2024, 1, 2), "line")
    assert dims.ped_config_on(config, dt.date(2024, 1, 2), "line").isEmpty()
    assert values(dims.latest_det_config(config, dt.date(2024, 1, 2)), "line") == [(0,), (1,), (2,)]
    old = config.withColumn("date", F.lit(dt.date(2019, 1, 1)))
    assert not dims.ped_config_on(old, dt.date(2015, 1, 1), "line").isEmpty()


def test_camera_config(spark):
    cams = spark.createDataFrame(
        [("c1", "pole", 1, None, True), ("c1", "pole", 1, None, True), ("c2", "x", 9, None, True), ("c3", "x", 1, None, False), (None, "x", 1, None, True)],
        "CameraID string, Location string, `MaxView ID` bigint, As_of_Date timestamp_ntz, Include boolean",
    )
    place = spark.createDataFrame([(1, "k", "d", "A", None)], "SignalID bigint, Contract string, District string, Corridor string, Subcorridor string")
    assert values(dims.camera_config(cams, place), "CameraID", "MaxView ID", "Description") == [("c1", 1, "c1: pole")]


def test_alerts(spark):
    yesterday, old = TODAY - dt.timedelta(days=1), TODAY - dt.timedelta(days=91)
    bad = spark.createDataFrame([(1, 1, yesterday), (1, 1, old), (1, 1, TODAY), (2, 1, yesterday)], "SignalID bigint, Detector bigint, Date date")
    config = spark.createDataFrame(
        [(1, 2, 1, "NB", 3, yesterday)], "SignalID bigint, CallPhase int, Detector bigint, ApproachDesc string, LaneNumber int, Date date"
    )
    place = spark.createDataFrame([("g", "z", "Ramp Meter", 1, "a @ b")], "Zone_Group string, Zone string, Corridor string, SignalID bigint, Name string")
    out = alerts.vehicle_alerts(bad, config, place, TODAY)
    assert values(out, "SignalID", "Name", "ApproachDesc", "Alert") == [(1, "a - b", "NB Lane 3", "Bad Vehicle Detection")]
    ped = alerts.ped_alerts(bad, place, TODAY)
    assert values(ped, "SignalID", "Corridor") == [(1, "Ramp Meter"), (2, None)]


def test_mart_reads(spark, tmp_path):
    month = dt.date(2024, 2, 1)
    rows = [("Zone 1", "A", dt.date(2024, 1, 1), 1.0), ("Zone 1", "A", month, 2.0), ("Zone 9", "B", month, 3.0)]
    df = spark.createDataFrame(rows, "Zone_Group string, Corridor string, Month date, v double")
    root = str(tmp_path)
    for level in ("cor", "sub", "sig"):
        sinks.save_mart(df, root, level, "mo", "m")
    metric = {"table": "m"}
    assert values(marts.query_mart(spark, root, metric, zone_group="Zone 1", month=month), "v") == [(1.0,), (2.0,)]
    assert values(marts.query_mart(spark, root, metric, zone_group="Zone 1", month=month, upto=False), "v") == [(2.0,)]
    every = marts.query_mart(spark, root, metric, "signal", zone_group="All", month=month, upto=False)
    assert values(every, "v") == [(2.0,), (3.0,)]
    assert values(marts.query_health(spark, root, "m", "corridor", "All RTOP", None, month), "v") == [(2.0,)]
    assert values(marts.query_health(spark, root, "m", "corridor", "Zone 9", "All Corridors", month), "v") == [(3.0,)]
    assert values(marts.query_health(spark, root, "m", "subcorridor", "Zone 9", "B", month), "v") == [(3.0,)]
    plan = marts.query_mart(spark, root, metric, zone_group="Zone 1", month=month)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(Zone_Group), IsNotNull(Month), EqualTo(Zone_Group,Zone 1)" in plan


def test_latest_rows(spark):
    rows = [("m", "z", at("2024-01-02"), 1), ("m", "z", at("2024-01-02"), 2), ("m", "z", at("2024-01-01"), 3), ("m", "y", at("2024-01-01"), 4)]
    df = spark.createDataFrame(rows, "Month string, Zone string, LastModified timestamp_ntz, entry int")
    assert values(marts.last_modified(df), "entry") == [(1,), (2,), (4,)]
    assert values(marts.last_modified(df, zone="y"), "entry") == [(4,)]
    assert values(marts.latest_entries(df, F.asc("entry"), 2), "entry") == [(1,), (2,), (4,)]
    plan = marts.latest_entries(df, F.asc("entry"), 2)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_goals_and_value_box(spark):
    df = spark.createDataFrame([("du", 0.95), ("du", 0.96), ("sf", 0.01), ("none", 1.0)], "metric string, v double")
    assert values(marts.with_goals(df, "v"), "metric", "v", "goal_met") == [
        ("du", 0.95, False), ("du", 0.96, True), ("none", 1.0, None), ("sf", 0.01, True),
    ]
    box = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1234.56, 0.015), ("A", dt.date(2024, 2, 1), 2.0, None)], "Corridor string, Month date, v double, delta double")
    assert values(marts.value_box(box, "v", "integer", "A", dt.date(2024, 1, 1)), "val", "del") == [("1,234", " (+1.5%)")]
    assert values(marts.value_box(box, "v", "decimal", "A", dt.date(2024, 2, 1)), "val", "del") == [("2.00", " (0.0%)")]
    assert values(marts.series_ends(box, "v", ["Corridor"]), "first", "last") == [(1234.56, 2.0)]


def test_dashboard_hours(spark):
    hourly = spark.createDataFrame([("g", "A", at("2024-01-01 05:00"), 1.0), ("g", "g", at("2024-01-31 05:00"), 2.0)], "Zone_Group string, Corridor string, Hour timestamp_ntz, v double")
    month = dt.date(2024, 1, 1)
    weekly = spark.createDataFrame([("g", "A", dt.date(2024, 1, 31), 1.0), ("g", "A", dt.date(2024, 1, 30), 2.0)], "Zone_Group string, Corridor string, Date date, v double")
    monthly = spark.createDataFrame([("g", "A", month, 5.0), ("g", "g", month, 4.0)], "Zone_Group string, Corridor string, Month date, v double")
    out = marts.dashboard_slices(weekly, monthly, "v", month, "g", "red", hourly)
    assert [tuple(r) for r in out["month"].collect()] == [("g", 4.0, "red"), ("A", 5.0, "lightgray")]
    assert values(out["week"], "var") == [(2.0,)]
    assert values(out["hour"], "var", "col") == [(1.0, 1), (2.0, 0)]
    assert marts.dashboard_slices(weekly, monthly, "v", month, "g", "red", hourly, first_day_only=True)["hour"].count() == 1


def test_formats(spark):
    df = spark.createDataFrame([(1234567.891, "currency"), (0.1234, "percent"), (5.0, "odd")], "x double, k string")
    assert [r[0] for r in df.select(fn.data_format("x", "k")).collect()] == ["$1,234,567.89", "12.3%", None]
    text = spark.createDataFrame([("", None), (None, 2), ("EB ", 1)], "a string, l int")
    assert [r[0] for r in text.select(fn.lane_text("a", "l")).collect()] == ["", "Lane 2", "EB  Lane 1"]


def test_resolve_date(spark):
    assert dates.resolve_date("yesterday", TODAY) == dt.date(2024, 3, 9)
    assert dates.resolve_date("10 days ago", TODAY) == dt.date(2024, 2, 29)
    assert dates.resolve_date("2024-01-31", TODAY) == dt.date(2024, 1, 31)
    assert dates.resolve_date("2024-01-31", TODAY, literal_plus_one=True) == dt.date(2024, 2, 1)
    assert dates.resolve_date("first_missing", TODAY) is None
    table = spark.createDataFrame([(dt.date(2024, 3, 1),), (dt.date(2024, 3, 4),)], "date date")
    assert dates.resolve_date("first_missing", TODAY, table) == dt.date(2024, 3, 5)
    assert dates.resolve_date("first_missing", dt.date(2024, 3, 2), table) == dt.date(2024, 3, 1)
    assert dates.month_span(dt.date(2023, 11, 30), dt.date(2024, 1, 1)) == ["2023-11", "2023-12", "2024-01"]
    assert dates.report_months(dt.date(2024, 3, 3))[0] == dt.date(2023, 2, 1)
    assert dates.report_months(dt.date(2024, 3, 3))[-1] == dt.date(2024, 2, 1)


def test_zone_sets():
    assert filters.zone_set("RTOP2")[:2] == ["All RTOP", "RTOP2"]
    assert len(filters.zone_set("All RTOP")) == 3 + 4 + 5


def test_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(at("2024-03-10 02:17:31.5"),)], "t timestamp_ntz")
        assert df.select(fn.floor_minutes("t", 15)).first()[0] == at("2024-03-10 02:15")
        assert df.select(F.unix_micros(fn.naive_as_utc("t"))).first()[0] == 1710037051500000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_as_of_join_with_gaps_and_ties(spark):
    import random

    rng = random.Random(5)
    start = dt.date(2024, 1, 1)
    key = lambda: rng.choice([1, 1, 1, 2, 3, None])
    day = lambda: rng.choice([None, *[start + dt.timedelta(days=rng.randrange(400)) for _ in range(12)]])
    history = [(key(), day(), rng.randrange(5), rng.choice([None, "a", "b"])) for _ in range(120)]
    rows = [(key(), day(), i) for i in range(200)]
    got = scale.as_of_join(
        spark.createDataFrame(rows, "k int, d date, i int"), spark.createDataFrame(history, "k int, d date, v int, w string"), ["k"], "d", ["v", "w"])

    def last(k, d):
        if k is None or d is None:
            return None, None
        known = [(h[1], (h[2], h[3] is not None, h[3] or "")) for h in history if h[0] == k and h[1] and h[1] <= d]
        if not known:
            return None, None
        v, has, w = max(known)[1]
        return v, w if has else None

    assert values(got, "k", "d", "i", "v", "w") == sorted(((k, d, i, *last(k, d)) for k, d, i in rows), key=repr)
    assert any(last(k, d)[0] is not None for k, d, _ in rows)


def test_config_of_every_day(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 9)]
    config = spark.createDataFrame([(days[2], 1), (days[2], 2), (days[5], 3)], "date date, Detector int")
    asked = spark.createDataFrame([(d,) for d in days] * 2, "date date")
    assert values(dims.det_config_dates(asked, config), "date", "config_date") == [
        (d, None if d < days[2] else days[2] if d < days[5] else days[5]) for d in days]
    for d in days[2:]:
        assert values(dims.det_config_of_days(asked, config).where(F.col("date") == F.lit(d)), "Detector") == values(dims.latest_det_config(config, d), "Detector")
