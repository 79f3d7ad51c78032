"""Nearest locations, lines and colours."""

import math
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corridor_metrics.functions import columns as fn
from corridor_metrics.operators import geo

M = 1 / geo.METRES_PER_DEGREE


def frames(spark, signals, locations):
    sig = spark.createDataFrame(signals, "SignalID string, Longitude double, Latitude double")
    loc = spark.createDataFrame(locations, "`DB Id` bigint, Longitude double, Latitude double")
    return sig, loc


def brute(signals, locations, radius=100):
    out = []
    for s, x, y in signals:
        d, best = min((math.sqrt((x - a) * (x - a) + (y - b) * (y - b)), i) for i, a, b in locations)
        if d * geo.METRES_PER_DEGREE < radius:
            out.append((s, best, int(d * geo.METRES_PER_DEGREE)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("pairs", [256, 0])
def test_radius_is_strict_and_ties_take_the_smallest_id(spark, pairs):
    sig, loc = frames(
        spark,
        [("in", 0.0, 0.0), ("out", 1.0, 0.0), ("tie", 2.0, 0.0), ("far", 9.0, 9.0)],
        [(1, 99 * M, 0.0), (2, 1 + 101 * M, 0.0), (4, 2 + 50 * M, 0.0), (3, 2 - 50 * M, 0.0)],
    )
    out = values(geo.nearest_location(sig, loc, pairs_per_point=pairs), "SignalID", "DB Id")
    # the two halves of the tie are not exactly equal in floating point, so only the winner's set is fixed
    assert [s for s, _ in out] == ["in", "tie"] and out[0][1] == 1


def test_equal_distance(spark):
    sig, loc = frames(spark, [("t", 0.5, 0.5)], [(9, 0.5 + 2**-12, 0.5), (7, 0.5 - 2**-12, 0.5), (8, 0.5, 0.5 + 2**-12)])
    assert values(geo.nearest_location(sig, loc), "DB Id", "m") == [(7, int(2**-12 * geo.METRES_PER_DEGREE))]


@pytest.mark.parametrize("spread", [4000, 150, 8, 1])
@pytest.mark.parametrize("pairs", [10**9, 0])
def test_grid_equals_brute_force(spark, spread, pairs):
    rnd = random.Random(spread)

    def point():
        return rnd.uniform(-spread, spread) * M, rnd.uniform(-spread, spread) * M

    signals = [(f"s{i}", *point()) for i in range(120)] + [(f"c{i}", 10 * M, 10 * M) for i in range(40)]
    locations = [(i, *point()) for i in range(150)] + [(1000 + i, 12 * M, 12 * M) for i in range(40)]
    sig, loc = frames(spark, signals, locations)
    got = values(geo.nearest_location(sig, loc, pairs_per_point=pairs), "SignalID", "DB Id", "m")
    assert got == brute(signals, locations)


def test_no_cross_join(spark):
    sig, loc = frames(spark, [("a", 0.0, 0.0)], [(1, 0.0, 0.0)])
    plan = geo.nearest_location(sig, loc)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pairs_are_not_sorted(spark):
    # a minimum over a struct would sort its input, which is every pair of points
    sig, loc = frames(spark, [("a", 0.0, 0.0)], [(1, 0.0, 0.0)])
    plan = geo.nearest_location(sig, loc)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


@pytest.mark.parametrize("name", ["e12_best_match_per_location", "g21_maintenance_match"])
def test_queries_of_matches_sort_no_pairs(spark, small, name):
    plan = entry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_split_pairs_of_cells_are_not_sorted(spark):
    # one window, over the nine neighbours of the coarsest cells, on any path of the plan: none on the levels below
    kinds = [[spark.createDataFrame([], f"{s}x bigint, {s}y bigint, {s}n bigint, {s}px bigint, {s}py bigint") for _ in range(geo.LEVELS + 1)] for s in "sl"]
    near = geo._neighbour_cells(kinds[0][0], kinds[1][0])
    open_windows = []
    for line in geo._refined_cells(near, *kinds)._jdf.queryExecution().analyzed().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        open_windows = [d for d in open_windows if d < depth]
        if "Window [" in line:
            assert not open_windows
            open_windows.append(depth)


@pytest.mark.parametrize("pairs", [256, 0])
def test_exact_ties_take_the_smallest_id(spark, pairs):
    ring = [(2, 0), (-2, 0), (0, 2), (0, -2)]
    signals = [(f"s{i}", 0.5, 0.5 + i * 2**-6) for i in range(6)] + [("copy", 0.5, 0.5)]
    locations = [(100 * (6 - i) + k, 0.5 + a * 2**-14, 0.5 + i * 2**-6 + b * 2**-14) for i in range(6) for k, (a, b) in enumerate(ring)]
    sig, loc = frames(spark, signals, [(n + 1000, a, b) for n, a, b in locations] + locations)
    got = values(geo.nearest_location(sig, loc, pairs_per_point=pairs), "SignalID", "DB Id", "m")
    assert got == [("copy", 600, 13)] + [(f"s{i}", 600 - 100 * i, 13) for i in range(6)]


def test_identifier_beats_distance(spark):
    sig = spark.createDataFrame(
        [(1, "p", "q", 0.0, 50 * M), (2, "p", "q", 0.0, 10 * M), (3, "p", "q", 0.0, 5.0)],
        "SignalID int, PrimaryName string, SecondaryName string, Longitude double, Latitude double",
    ).withColumn("Latitude", F.col("Latitude") + 1)
    loc = spark.createDataFrame(
        [(7, "us", "1 main", "c", "k", 0.0, 1.0)],
        "`DB Id` bigint, `Maintained By` string, `Custom Identifier` string, City string, County string, Longitude double, Latitude double",
    )
    assert values(geo.maintenance_match(sig, loc), "SignalID", "LocationId") == [("1", 7)]


def test_points(spark):
    df = spark.createDataFrame([("no quote",), (None,)], "s string")
    assert [r[0] for r in df.select(fn.segment_points("s")).collect()] == [[], []]
    df = spark.createDataFrame([("LINE '1 2,  3.5 4'",)], "s string")
    assert df.select(fn.line_wkt(fn.segment_points("s"))).first()[0] == "LINESTRING (1.0 2.0, 3.5 4.0)"
    df = spark.createDataFrame([("1 2:3 4,1 2",), (None,)], "s string")
    assert [len(r[0]) for r in df.select(fn.geometry_points("s")).collect()] == [2, 0]


def test_lines(spark):
    df = spark.createDataFrame([("a", 2, 3.0, 4.0), ("a", 1, 1.0, 2.0), ("b", 1, 5.0, 6.0), (None, 1, 0.0, 0.0)], "i string, o int, x double, y double")
    assert values(geo.points_to_line(df, "x", "y", "o", "i"), "i", "geometry") == [
        ("a", "LINESTRING (1.0 2.0, 3.0 4.0)"), ("b", "LINESTRING (5.0 6.0)"),
    ]
    whole = geo.points_to_line(df.where("i = 'a'"), "x", "y", "o")
    assert values(whole, "geometry") == [("LINESTRING (1.0 2.0, 3.0 4.0)",)]


def test_palette_cycles(spark):
    df = spark.createDataFrame([("Zone 1", f"c{i:02d}") for i in range(10)] + [("Other", "x")], "Zone string, Corridor string")
    colors = dict(values(geo.corridor_colors(df), "Corridor", "color"))
    assert colors["c00"] == colors["c08"] == fn.PALETTE[0] and colors["None"] == fn.GRAY and "x" not in colors
