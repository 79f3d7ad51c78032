"""Weighted means, changes and ordered scans on hand-made frames."""

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corridor_metrics.operators import rollups as ops
from corridor_metrics.operators import scale, selection, travel

CORRIDORS = [
    (1, "RTOP1", "Zone 1", "A", "a1"), (2, "RTOP1", "Zone 1", "A", "a2"), (3, "RTOP2", "Zone 7m", "B", None),
    (4, "Other", "Zone 9", None, None), (5, "Other", "Zone 9", "C", "c1"),
]
CORRIDOR_SCHEMA = "SignalID bigint, Zone_Group string, Zone string, Corridor string, Subcorridor string"


@pytest.fixture(scope="module")
def corridors(spark):
    return spark.createDataFrame(CORRIDORS, CORRIDOR_SCHEMA)


def metric(spark, rows):
    return spark.createDataFrame(rows, "SignalID bigint, Month string, v double, w double")


def test_weighted_mean_keeps_weight_of_null_values(spark, corridors):
    df = metric(spark, [(1, "m1", 10.0, 1.0), (2, "m1", None, 3.0), (4, "m1", 99.0, 9.0), (5, "m1", 2.0, 0.0), (5, None, 7.0, 7.0)])
    out = ops.weighted_mean_by_corridor(df, "Month", corridors, "v", "w")
    assert values(out, "Corridor", "v", "w", "delta") == [("A", 2.5, 4.0, None), ("C", None, 0.0, None)]


def test_all_null_values_count_zero(spark, corridors):
    out = ops.weighted_mean_by_corridor(metric(spark, [(1, "m1", None, 2.0)]), "Month", corridors, "v", "w")
    assert values(out, "v", "w") == [(0.0, 2.0)]


def test_delta_scopes(spark):
    df = metric(spark, [(1, "m1", 4.0, 1.0), (1, "m2", 5.0, 1.0), (2, "m1", 10.0, 1.0), (2, "m2", 0.0, 1.0), (2, "m3", 1.0, 1.0)])
    own = ops.period_avg(df, "v", "Month", "w")
    assert values(own, "SignalID", "Month", "delta") == [
        (1, "m1", None), (1, "m2", 0.25), (2, "m1", None), (2, "m2", -1.0), (2, "m3", None),
    ]
    frame = ops.period_avg(df, "v", "Month", "w", lag_scope="frame")
    assert values(frame, "SignalID", "Month", "delta") == [
        (1, "m1", None), (1, "m2", 0.25), (2, "m1", 1.0), (2, "m2", -1.0), (2, "m3", None),
    ]
    with pytest.raises(ValueError):
        ops.period_avg(df, "v", "Month", "w", lag_scope="other")


def test_overlapping_groups(spark, corridors):
    df = metric(spark, [(1, "m1", 1.0, 1.0), (3, "m1", 3.0, 3.0), (5, "m1", 5.0, 1.0)])
    by_corridor = ops.weighted_mean_by_corridor(df, "Month", corridors, "v", "w")
    groups = ops.corridor_groups(by_corridor, "Month", "v", "w").where("Zone_Group is not null")
    assert values(groups, "Corridor", "v", "w") == [
        ("All RTOP", 2.5, 4.0), ("RTOP1", 1.0, 1.0), ("RTOP2", 3.0, 3.0), ("Zone 1", 1.0, 1.0), ("Zone 7", 3.0, 3.0),
        ("Zone 7m", 3.0, 3.0), ("Zone 9", 5.0, 1.0),
    ]
    one = ops.corridor_group(by_corridor.where("Zone_Group in ('RTOP1', 'RTOP2')"), "Month", "v", "w", "All RTOP")
    assert values(one, "Zone_Group", "v", "w") == [("All RTOP", 2.5, 4.0)]


def test_group_function_can_be_replaced(spark, corridors):
    by_corridor = ops.weighted_mean_by_corridor(metric(spark, [(1, "m1", 1.0, 1.0)]), "Month", corridors, "v", "w")
    out = ops.corridor_groups(by_corridor, "Month", "v", "w", lambda df, per, v, w: ops.corridor_group(df, per, v, w, "mine"))
    assert values(out, "Corridor") == [("A",), ("mine",)]


def test_zone_weights_add_up(spark, corridors):
    rows = [(1 + i % 5, f"m{i % 3}", float(i % 7), float(i % 4)) for i in range(200)]
    by_corridor = ops.weighted_mean_by_corridor(metric(spark, rows), "Month", corridors, "v", "w")
    zones = ops.zone_roll_up(by_corridor, "Month", "v", "w").where("Zone_Group like 'Zone %' and Zone_Group <> 'Zone 7'")
    total = by_corridor.agg(F.sum("w")).first()[0]
    assert zones.agg(F.sum("w")).first()[0] == total


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    key = F.when(F.col("id") < 200, 7).when(F.col("id") % 9 != 0, F.col("id") % 50)
    fact = spark.range(600).select(key.alias("k"), "id")
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    small = scale.checked_join(fact, dim, ["k"], how)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        large = scale.checked_join(fact, dim, ["k"], how)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(large.columns) == sorted(small.columns)
    assert values(small, *small.columns) == values(large, *small.columns)


def test_hot_key_is_spread(spark):
    fact = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"), "id")
    assert values(scale.hot_keys(fact, ["k"], 10), "k") == [(7,)]
    dim = fact.select("k").distinct().withColumn("x", F.col("k") * 2)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = scale.spread_join(fact, dim, ["k"], share=10)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.count() == 3000 and max(sizes) < 1000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.integers(0, 6)), unique=True, min_size=1, max_size=40))
def test_frame_lag_equals_plain_lag(spark, keys):
    rows = [(*k, float(i)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "a int, b int, c int, v double")
    ordered = sorted(rows)
    expected = sorted((r[0], r[1], r[2], p[3] if p else None) for r, p in zip(ordered, [None, *ordered]))
    out = scale.lag_over_frame(df, ["a", "b", "c"], "v", "p")
    got = sorted(tuple(r) for r in out.select("a", "b", "c", "p").collect())
    assert got == expected


def test_frame_lag_with_nulls_evaluates_its_input_once(spark):
    scans = spark.sparkContext.accumulator(0)

    def count(x):
        scans.add(1)
        return x

    rows = [(a, b, c, None if (a, b, c) == (2, None, 1) else float(i)) for i, (a, b, c) in enumerate((a, b, c) for a in (None, 1, 2) for b in (None, 5) for c in (None, 1))]
    df = spark.createDataFrame(rows, "a int, b int, c int, w double").withColumn("v", F.udf(count, "double").asNondeterministic()("w"))
    spark.sparkContext.setJobGroup("frame-lag", "building")
    try:
        out = scale.lag_over_frame(df, ["a", "b", "c"], "v", "p")
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("frame-lag")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {(r.a, r.b, r.c, r.p) for r in out.collect()}
    ordered = sorted(rows, key=lambda r: [(x is not None, x or 0) for x in r[:3]])
    assert got == {(*r[:3], p[3] if p else None) for r, p in zip(ordered, [None, *ordered])}
    assert scans.value == len(rows)


def test_row_numbers_in_ranges(spark):
    df = spark.range(0, 500, 3).select((F.col("id") * 7 % 501).alias("k")).distinct()
    small = scale.row_numbers(df, "k", "n")
    large = scale.row_numbers(df, "k", "n", max_rows=0, parts=5)
    assert values(small, "k", "n") == values(large, "k", "n")


def test_block_lag_crosses_blocks(spark):
    rows = [("x", d, h, float(10 * d + h)) for d in range(4) for h in range(3) if d != 2]
    df = spark.createDataFrame(rows, "e string, d int, h int, v double").withColumn("o", F.col("d") * 10 + F.col("h"))
    out = scale.lag_in_blocks(df, ["e"], "d", "o", "v", "p")
    got = [tuple(r) for r in out.orderBy("o").select("v", "p").collect()]
    flat = [r[3] for r in rows]
    assert got == list(zip(flat, [None, *flat[:-1]]))


def test_hourly_frame_scope(spark, corridors):
    df = spark.createDataFrame(
        [(1, "2024-01-01 00:00", 2.0), (1, "2024-01-01 01:00", 3.0), (2, "2024-01-01 00:00", 6.0)], "SignalID bigint, h string, v double"
    ).select("SignalID", F.to_timestamp_ntz("h").alias("Hour"), "v")
    assert [r[1] for r in values(ops.hourly_by_signal(df, "v", corridors), "v", "delta")] == [None, 0.5, None]
    assert [r[1] for r in values(ops.hourly_by_signal(df, "v", corridors, "frame"), "v", "delta")] == [None, 0.5, 1.0]


def test_peak_hours_and_camera(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01 07:10", 2.0), (1, "2024-01-01 12:00", 8.0), (1, "2024-01-02 08:00", 4.0)], "SignalID bigint, t string, v double"
    ).select("SignalID", F.to_timestamp_ntz("t").alias("Date_Hour"), F.to_date("t").alias("Date"), "v")
    out = ops.daily_avg(df, "v", peak_only=True, hours=(7, 8))
    assert values(out, "v", "ones", "delta") == [(2.0, 1.0, None), (4.0, 1.0, 1.0)]


def test_subcorridors_move_one_level_down(corridors):
    subs = ops.subcorridors_of(corridors)
    assert values(subs, "SignalID", "Zone_Group", "Zone", "Corridor") == [
        (1, "Zone 1", "A", "a1"), (2, "Zone 1", "A", "a2"), (5, "Zone 9", "C", "c1"),
    ]


def test_percentile_equals_the_built_in_one(spark):
    import random

    rng = random.Random(3)
    rows = [("even", rng.gauss(50, 20)) for _ in range(3000)] + [("one", 7.5), ("two", 1.0), ("two", 2.0), ("none", None), ("none", None)]
    rows += [("same", 3.0)] * 40 + [("steps", float(rng.randrange(9))) for _ in range(500)] + [("far", x) for x in (1e-300, 1.0, 2.0, 3.0, 1e300, None)]
    rows += [("signs", rng.gauss(0, 1)) for _ in range(301)] + [("near", 1.0 + i * 2.0**-52) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, v double")
    counted = df.groupBy("k", "v").agg(F.count("*").alias("n"))
    for share in (0.0, 0.37, 0.9, 1.0):
        want = values(df.groupBy("k").agg(F.percentile("v", share).alias("p")), "k", "p")
        for resolution in (selection.RESOLUTION, 1):
            assert values(selection.grouped_percentile(counted, ["k"], "v", "n", share, "p", resolution), "k", "p") == want


def test_speed_index_of_continuous_speeds(spark):
    speeds = spark.range(20000).select(F.lit("c").alias("Corridor"), (F.rand(5) * 70).alias("speed"))
    limits = spark.createDataFrame([("c", 35.0)], "Corridor string, `Speed Limit` double")
    want = speeds.agg(F.percentile("speed", 0.9)).first()[0] / 35
    assert values(travel.relative_speed_index(speeds, limits, ["Corridor"]), "rsi") == [(want,)]
    plan = travel.relative_speed_index(speeds, limits, ["Corridor"])._jdf.queryExecution().toString()
    assert "percentile(" not in plan and "collect_" not in plan
