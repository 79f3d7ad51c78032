"""Reads, writes, catalog upkeep and streams."""

import datetime as dt
import os
import uuid
from dataclasses import replace

import pytest
from conftest import at, values
from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.context import RunContext, scratch_path, shared_dir
from corridor_metrics.operators import counts as ops
from corridor_metrics.plans import counts_jobs, travel_jobs, uptime_reports
from corridor_metrics.sources import catalog, lake, sinks
from corridor_metrics.streaming import counts_stream, reactive

D1, D2, D3 = (dt.date(2024, 1, d) for d in (1, 2, 3))


def table(spark, rows=((1, D1, 10), (2, D1, 20), (1, D2, 30), (1, D3, 40))):
    return spark.createDataFrame(list(rows), "SignalID bigint, Date date, vol bigint")


def test_write_by_date_replaces_only_its_dates(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_by_date(table(spark), root, "t")
    sinks.write_by_date(table(spark, [(9, D2, 99)]), root, "t")
    out = sinks.read_back(spark, root, "t")
    assert values(out, "SignalID", "date", "vol") == [("1", D1, 10), ("1", D3, 40), ("2", D1, 20), ("9", D2, 99)]
    assert dict(out.dtypes)["SignalID"] == "string"
    sinks.write_date(table(spark, [(5, D1, 7)]), root, "t", D3)
    assert values(sinks.read_back(spark, root, "t").where(F.col("date") == F.lit(D3)), "SignalID", "vol") == [("5", 7)]


def test_read_dates_prunes_partitions_and_filters_signals(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_by_date(table(spark).withColumn("__i", F.lit(1)), root, "t")
    df = lake.read_dates(spark, root, "t", D1, D2, ["1"])
    assert values(df, "Date", "SignalID", "vol") == [(D1, "1", 10), (D2, "1", 30)]
    assert "__i" not in df.columns
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(SignalID), EqualTo(SignalID,1)]" in plan
    doubled = lake.read_dates(spark, root, "t", D1, D3, callback=lambda d: d.groupBy("Date").agg(F.sum("vol").alias("v")))
    assert values(doubled, "Date", "v") == [(D1, 30), (D2, 30), (D3, 40)]
    some = lake.read_dates(spark, root, "t", D1, D3, spark.createDataFrame([("2",)], "SignalID string"))
    assert values(some, "vol") == [(20,)]


def test_read_object(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_by_date(table(spark).withColumn("__i", F.lit(1)), root, "t")
    df = lake.read_object(spark, f"{root}/t/date=2024-01-02")
    assert df.columns == ["SignalID", "vol", "Date"] and values(df, "Date") == [(D2,)]
    assert values(lake.read_object(spark, f"{root}/t/date=2024-01-02", D3), "Date") == [(D3,)]
    assert lake.read_object(spark, f"{root}/none").isEmpty()


def test_latest_feed_of_files_and_of_folders(spark, tmp_path):
    def line(i):
        return f"SignalID,PrimaryName,SecondaryName,Latitude,Longitude\n{i},a,b,1,2\n"

    flat, mixed = tmp_path / "flat files", tmp_path / "folders"
    for name, ids in (("feed_2024-01-01.csv", (1,)), ("feed_2024-02-01.csv", (2,))):
        flat.mkdir(exist_ok=True)
        (flat / name).write_text("".join(line(i) for i in ids))
    for name, ids in (("feed_2024-01-01", (1, 2)), ("feed_2024-02-01", (3, 4, 5))):
        (mixed / name).mkdir(parents=True)
        for i in ids:
            (mixed / name / f"part-{i}.csv").write_text(line(i))
    (mixed / "feed_2024-01-15.csv").write_text(line(9))

    def last(folder, source):
        return values(lake.latest_feed(lake.read_csv(spark, f"{folder}/feed*", "intersections"), source), "SignalID")

    for prefix, slash in (("", ""), ("file:", ""), ("file://", "/")):
        assert last(flat, f"{prefix}{flat}{slash}") == [("2",)]
        assert last(mixed, f"{prefix}{mixed}{slash}") == [("3",), ("4",), ("5",)]
    (mixed / "feed_2024-03-01.csv").write_text(line(7))
    assert last(mixed, str(mixed)) == [("7",)]


def test_month_read(spark, tmp_path):
    rows = [(1, dt.date(2024, 1, 31), 1), (1, dt.date(2024, 2, 1), 2), (1, dt.date(2024, 2, 29), 3), (1, dt.date(2024, 3, 1), 4)]
    sinks.write_by_date(table(spark, rows), str(tmp_path), "t")
    assert values(lake.read_month(spark, str(tmp_path), "t", dt.date(2024, 2, 10)), "vol") == [(2,), (3,)]


def test_mart_drops_early_rows(spark, tmp_path):
    path = sinks.save_mart(table(spark), str(tmp_path), "sig", "dy", "du", D2)
    assert path.endswith("/sig_dy_du") and values(spark.read.parquet(path), "vol") == [(30,), (40,)]


def test_manifest_and_freshness(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.CSV").write_text("12345")
    (tmp_path / "y.json").write_text("1")
    files = lake.manifest(spark, str(tmp_path), [".csv"])
    assert values(files, "length", "extension") == [(5, ".csv")]
    every = lake.manifest(spark, str(tmp_path))
    assert lake.manifest_summary(every, F.col("length") > 1).first().asDict() == {"total_files": 2, "successful": 1, "failed": 1}
    sinks.write_snapshot(table(spark), str(tmp_path / "p"))
    newest = lake.freshness(spark.read.parquet(str(tmp_path / "p"))).first()[0]
    assert newest.timestamp() <= dt.datetime.now().timestamp() + 5


def test_manifest_of_the_test_tables(spark, small):
    got = {os.path.basename(r["path"]): r["length"] for r in lake.manifest(spark, small, [".parquet"]).collect()}
    assert got == {n: os.path.getsize(f"{small}/{n}") for n in os.listdir(small) if n.endswith(".parquet")}


@pytest.fixture()
def name(spark):
    n = f"t_{uuid.uuid4().hex}"
    yield n
    spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_partition_upkeep(spark, tmp_path, name):
    today = dt.date(2024, 3, 15)
    catalog.create_mart_table(spark, name, str(tmp_path / "m"), today)
    months = sorted(r[0] for r in catalog.partitions(spark, name).collect())
    assert len(months) == 12 and months[0] == dt.date(2023, 5, 1) and months[-1] == dt.date(2024, 4, 1)
    catalog.add_next_month(spark, name, dt.date(2024, 4, 30))
    assert catalog.drop_expired(spark, name, today) == 3
    left = sorted(r[0] for r in catalog.partitions(spark, name).collect())
    assert left[0] == dt.date(2023, 8, 1) and left[-1] == dt.date(2024, 5, 1)


@pytest.mark.parametrize("days", [3, 12])
def test_missing_dates_are_registered(spark, tmp_path, name, days):
    dates = [D1 + dt.timedelta(days=i) for i in range(days)]
    sinks.write_by_date(table(spark, [(1, d, 1) for d in dates]), str(tmp_path), "t")
    spark.sql(f"CREATE TABLE {name} (SignalID STRING, vol BIGINT, date DATE) USING parquet PARTITIONED BY (date) LOCATION '{tmp_path}/t'")
    assert catalog.sync_dates(spark, name, dates[0], dates[-1] + dt.timedelta(days=20)) == days  # only what lies there
    assert catalog.sync_dates(spark, name, dates[0], dates[-1]) == 0
    assert spark.table(name).count() == days
    sinks.write_date(table(spark, [(1, D1, 1)]), str(tmp_path), "t", dt.date(2024, 2, 1), name)
    assert catalog.partitions(spark, name).count() == days + 1


def test_scratch_uses_the_shared_folder(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))
    assert spark.conf.get("spark.checkpoint.dir", None) == before


def test_stream_equals_batch(spark, small, tmp_path):
    """Files out of order over several triggers, late events, NULL keys and a batch that runs again."""
    t = tv.Tables(spark, small)
    events = tv.event_log(t).withColumn("signalid", F.when(F.col("signalid") % 7 != 0, F.col("signalid") % 20))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    half = F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")

    def run(at_once=1):
        stream = counts_stream.event_stream(spark, source, events.schema, at_once)
        counts_stream.run_available(stream, out, state).awaitTermination()

    events.where(F.col("timestamp") >= half).repartition(3).write.parquet(source)
    run()
    events.where(F.col("timestamp") < half).repartition(2).write.mode("append").parquet(source)
    run()
    run()
    config = tv.det_config(t)
    columns = ["timeperiod", "signalid", "eventparam", "CallPhase", "vol"]
    expected = values(ops.detector_counts(events, config, "hours"), *columns)
    assert max(row[-1] for row in expected) > 1
    assert values(counts_stream.streamed_counts(spark, out, config), *columns) == expected
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    (last.parent / f".{last.name}.crc").unlink()
    last.unlink()  # the batch was written, but its end not noted
    run()
    assert last.exists() and values(counts_stream.streamed_counts(spark, out, config), *columns) == expected


def test_refresh_rewrites_only_on_change(spark, tmp_path):
    source, target = (str(tmp_path / n) for n in ("in", "out"))
    df = spark.createDataFrame([(1,)], "x int")
    df.coalesce(1).write.parquet(source)

    def poll():
        return reactive.refresh(spark, source, df.schema, target, lambda d: d.withColumn("y", F.lit(2)))

    poll()
    before = lake.freshness(reactive.current(spark, target)).first()[0]
    poll()
    assert lake.freshness(reactive.current(spark, target)).first()[0] == before
    spark.createDataFrame([(7,)], "x int").coalesce(1).write.mode("append").parquet(source)
    assert poll()
    assert values(reactive.current(spark, target), "x", "y") == [(1, 2), (7, 2)]  # the whole source
    name = next(p for p in (tmp_path / "in").iterdir() if p.suffix == ".parquet")
    spark.createDataFrame([(5,)], "x int").coalesce(1).write.parquet(str(tmp_path / "other"))
    fresh = next(p for p in (tmp_path / "other").iterdir() if p.suffix == ".parquet")
    for side in (tmp_path / "in").glob(".*.crc"):
        side.unlink()
    name.write_bytes(fresh.read_bytes())  # an object rewritten under its own name
    assert poll() and not poll()
    assert (5, 2) in values(reactive.current(spark, target), "x", "y") and reactive.current(spark, target).count() == 2


def test_counts_and_month_jobs(spark, small, tmp_path):
    t = tv.Tables(spark, small)
    ctx = RunContext(D1, dt.date(2024, 1, 30), dt.date(2024, 1, 31), root=str(tmp_path), thresholds=tv.THRESHOLDS)
    tables = counts_jobs.run_counts(tv.event_log(t), tv.det_config(t), ctx)
    assert tables == ["comm_uptime", "counts_1hr", "filtered_counts_1hr"]
    counts = tv.counts(t)
    filtered = ops.filtered_counts(counts, "15 min", thresholds=tv.THRESHOLDS)
    written = counts_jobs.run_month(counts, filtered, filtered, D1, ctx)
    for name in written:
        assert spark.read.parquet(f"{ctx.root}/{name}").count() > 0
    throughput = spark.read.parquet(f"{ctx.root}/throughput")
    expected = ops.throughput(tv.report_counts(t))
    assert values(throughput.select(F.col("SignalID").cast("long").alias("s"), "date", "vph"), "s", "date", "vph") == values(
        expected, "SignalID", "Date", "vph"
    )
    detail = spark.read.parquet(f"{ctx.root}/signal_details")
    assert detail.select(F.sum(F.size("data"))).first()[0] == counts.count()


def test_report_jobs(spark, small, tmp_path):
    t = tv.Tables(spark, small)
    ctx = RunContext(dt.date(1995, 1, 1), dt.date(1995, 3, 31), dt.date(1995, 4, 1), root=str(tmp_path), wk_calcs_start_date=dt.date(1994, 12, 26))
    paths = uptime_reports.run_detector_uptime(tv.daily_metric(t), tv.corridors(t), ctx)
    assert len(paths) == 9 and all(spark.read.parquet(p).count() > 0 for p in paths)
    ped = replace(ctx, start_date=D1, end_date=dt.date(2024, 1, 30), wk_calcs_start_date=None)
    paths = uptime_reports.run_ped_pushbutton_uptime(tv.report_counts(t), tv.corridors(t), ped)
    assert len(paths) == 9 and spark.read.parquet(paths[0]).count() > 0


def test_travel_job(spark, small, tmp_path):
    t, root = tv.Tables(spark, small), str(tmp_path)
    travel_jobs.write_travel_times(tv.readings(t), tv.segments(t), root)
    times = spark.read.parquet(f"{root}/travel_times_1min")
    indices = travel_jobs.speed_indices(times, tv.speed_limits(t), tv.injury_reference(t))
    travel_jobs.write_speed_indices(indices, root)
    months = values(spark.read.parquet(f"{root}/relative_speed_index/cor").select("month").distinct(), "month")
    assert months == [(dt.date(2024, m, 1),) for m in (1, 2, 3)]
    assert spark.read.parquet(f"{root}/bike_ped_safety_index/sub").count() > 0


def test_events_with_other_casing(spark, tmp_path):
    rows = [(at("2024-01-01 10:00"), 1, 82), (at("2024-01-02 23:59:59"), 1, 82), (at("2024-01-03"), 1, 82), (at("2024-01-02"), 2, 81)]
    spark.createDataFrame(rows, "Timestamp timestamp_ntz, SignalID bigint, EventCode int").write.parquet(str(tmp_path / "e"))
    out = lake.controller_events(spark, str(tmp_path / "e"), D1, D2, [1], [82])
    assert values(out, "timestamp") == [(at("2024-01-01 10:00"),), (at("2024-01-02 23:59:59"),)]
    twr = lake.controller_events(spark, str(tmp_path / "e"), D1, D2, twr_only=True)
    assert twr.count() == 2
