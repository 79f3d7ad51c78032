"""Every registered query against its SQL, and the shape of the driver contract."""

import re

import duckdb
import pytest
from conftest import values  # noqa: F401

import __spark_entry__ as entry
import check

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["Zone_Group", "Zone", "Corridor", "Date", "vph", "delta"]
    assert df.count() > 0


def test_keys_name_their_operator():
    assert set(ORACLES) <= set(QUERIES)
    assert all(re.fullmatch(r"[a-js]\d\d_[a-z0-9_]+|op\d+_[a-z0-9_]+|pipeline", k) for k in QUERIES)


# may be empty at the smallest scale
SPARSE = {"g03_mart_read_one_corridor_month", "c10_nearest_location", "e12_best_match_per_location", "g21_maintenance_match"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, small, name):
    verdict, _ = check.compare(spark, con, name, QUERIES[name], ORACLES.get(name), small)
    assert verdict.startswith(("ok", "rows-only")) or (verdict == "EMPTY" and name in SPARSE), verdict


LAZY = ["c10_nearest_location", "c13_config_of_the_same_date", "d10_detector_counts_hourly", "d21_detector_uptime_calendar",
        "e05_adjusted_counts_by_share", "e08_last_modified_with_ties", "e13_group_totals_on_rows", "g01_signal_detail",
        "g12_detector_uptime_report_signal_weekly", "g21_maintenance_match", "i02_split_failures", "e07_frame_order_delta", "d08_relative_speed_index_subcorridor",
        "d14_comm_uptime_by_signal", "g14_counts_job_filtered", "e02_volume_delta_frame_order"]


@pytest.mark.parametrize("name", LAZY)
def test_building_a_plan_runs_no_job(spark, small, name):
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, small)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup(f"build-{name}")
