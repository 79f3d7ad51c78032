"""Tables that change as a whole: readers during a change, failed writers, finished dates, merged batches."""

import datetime as dt
import random
import re
import threading
import time
from dataclasses import replace

import pytest
from conftest import at, values
from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.context import RunContext
from corridor_metrics.functions import dates
from corridor_metrics.operators import activity, counts as ops, uptime
from corridor_metrics.plans import counts_jobs, uptime_reports
from corridor_metrics.sources import catalog, lake, sinks, versions
from corridor_metrics.streaming import counts_stream, reactive

START = dt.date(2024, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


def test_spans_equal_sets_of_days():
    rng = random.Random(1)
    for _ in range(300):
        sides = [[(day(a), day(a + rng.randrange(4))) for a in (rng.randrange(30) for _ in range(rng.randrange(6)))] for _ in range(2)]
        one, two = ({day(n) for n in range(40) if any(a <= day(n) <= b for a, b in side)} for side in sides)
        assert dates.without_spans(*sides) == dates.spans_of(one - two)
        assert dates.joined_spans([*sides[0], *sides[1]]) == dates.spans_of(one | two)
    assert dates.first_missing([], day(9)) == day(8) and dates.first_missing([day(3)], day(9)) == day(4)
    assert dates.resolve_date("first_missing", day(9), [day(1), day(20)]) == day(8)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "x int, y string")


def test_tables_change_together(spark, tmp_path):
    root = str(tmp_path)
    versions.publish_tables(spark, root, {"a": frame(spark, (1, "old")), "b": frame(spark, (2, "old"))})
    before = versions.newest(spark, root)
    paths = versions.publish_tables(spark, root, {"a": versions.read_table(spark, root, "a").withColumn("y", F.lit("new"))}, note=7)
    assert values(versions.read_table(spark, root, "a"), "y") == [("new",)] == values(spark.read.parquet(paths["a"]), "y")
    assert values(versions.read_table(spark, root, "b"), "y") == [("old",)]  # not part of the change
    assert values(versions.read_table(spark, root, "a", before), "y") == [("old",)]  # a reader that began before
    assert versions.newest(spark, root)["note"] == 7 and "note" not in before
    with pytest.raises(versions.Superseded):
        versions.publish(spark, root, {**before, "number": 2})
    assert versions.newest(spark, root)["number"] == 2 and not [n for n in versions.names_in(spark, f"{root}/_states") if n.startswith(".") and n.endswith("json")]


def test_old_versions_are_removed_late(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        versions.publish_tables(spark, root, {"a": frame(spark, (n, "a"))} | ({"b": frame(spark, (0, "b"))} if n == 0 else {}))
    (tmp_path / "a" / "v=9").mkdir()  # of a writer that has not published yet
    assert versions.prune(spark, root) == 2
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["v=3", "v=4", "v=9"] and (tmp_path / "b" / "v=1").exists()
    assert values(versions.read_table(spark, root, "a"), "x") == [(3,)] and values(versions.read_table(spark, root, "b"), "y") == [("b",)]


def test_dates_are_replaced_and_pruned(spark, tmp_path):
    root = str(tmp_path)

    def rows(*pairs):
        return spark.createDataFrame([(v, day(n)) for n, v in pairs], "v0 int, date date")

    versions.publish_dates(spark, root, {"t": rows(*((n, n) for n in range(10)))}, [(day(0), day(9))])
    versions.publish_dates(spark, root, {"t": rows((3, 33))}, [(day(3), day(4))])  # day 4 has no rows any more
    versions.publish_dates(spark, root, {"t": rows((12, 12)).where("false")}, [(day(12), day(12))])
    df = versions.read_table(spark, root, "t")
    assert df.columns == ["v0", "date"]
    assert values(df, "v0", "date") == sorted([(33, day(3)), *((n, day(n)) for n in (0, 1, 2, 5, 6, 7, 8, 9))], key=repr)
    assert versions.finished(versions.newest(spark, root)) == [(day(0), day(9)), (day(12), day(12))]
    plan = df.where(F.col("date") == F.lit(day(3)))._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(date#\d+ = 2024-01-04\)", plan)
    versions.reopen(spark, root, [(day(5), day(6))])
    assert versions.finished(versions.newest(spark, root)) == [(day(0), day(4)), (day(7), day(9)), (day(12), day(12))]
    assert df.count() == 9


def test_reader_during_refreshes_sees_whole_versions(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    versions_seen, stop, failures = set(), threading.Event(), []

    def write(n):
        spark.range(50).select(F.lit(n).alias("n")).repartition(5).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(source)
        assert reactive.refresh(spark, source, spark.read.parquet(source).schema, target)

    def poll():
        while not stop.is_set():
            try:
                seen = [(r["n"], r["count"]) for r in reactive.current(spark, target).groupBy("n").count().collect()]
                assert len(seen) == 1 and seen[0][1] == 50, seen
                versions_seen.add(seen[0][0])
            except Exception as e:  # noqa: BLE001
                failures.append(e)

    write(0)
    reader = threading.Thread(target=poll)
    reader.start()
    try:
        for n in range(1, 4):
            write(n)
            time.sleep(0.5)
    finally:
        stop.set()
        reader.join()
    assert not failures and len(versions_seen) > 1


def test_failed_refresh_changes_nothing(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frame(spark, (1, "a")).write.parquet(source)
    schema = spark.read.parquet(source).schema
    reactive.refresh(spark, source, schema, target)
    frame(spark, (2, "b")).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="broken"):
        reactive.refresh(spark, source, schema, target, lambda df: df.withColumn("z", F.raise_error(F.lit("broken"))))
    assert values(reactive.current(spark, target), "x") == [(1,)]
    assert reactive.refresh(spark, source, schema, target)  # the change is still seen
    assert values(reactive.current(spark, target), "x") == [(1,), (2,)]


def test_refresh_by_the_clock(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    frame(spark, (1, "a")).write.parquet(source)
    clock = reactive.refresh_on_change(spark, source, spark.read.parquet(source).schema, target, str(tmp_path / "state"), 0.5)
    try:
        def wait(rows):
            until = time.time() + 60
            while time.time() < until:
                if versions.newest(spark, target)["tables"] and reactive.current(spark, target).count() == rows:
                    return True
                time.sleep(0.3)
            return False

        assert wait(1)
        frame(spark, (2, "b")).write.mode("append").parquet(source)
        assert wait(2)
    finally:
        clock.stop()


def report(spark, root, names):
    return {n: values(spark.read.parquet(p), *spark.read.parquet(p).columns) for n, p in names.items()}


def test_nine_marts_or_none(spark, small, tmp_path, monkeypatch):
    t = tv.Tables(spark, small)
    ctx = RunContext(dt.date(1995, 1, 1), dt.date(1995, 3, 31), dt.date(1995, 4, 1), root=str(tmp_path), wk_calcs_start_date=dt.date(1994, 12, 26))
    marts = [f"{level}_{per}_du" for level in ("sig", "cor", "sub") for per in ("dy", "wk", "mo")]
    uptime_reports.run_detector_uptime(tv.daily_metric(t), tv.corridors(t), ctx)

    def stored():
        return {m: values(df := versions.read_table(spark, ctx.root, m), *df.columns) for m in marts}

    before = stored()
    changed = tv.daily_metric(t).withColumn("uptime", F.col("uptime") / 2)
    writer, written = versions._writer, []

    def failing(df):
        written.append(df)
        if len(written) > 5:
            raise OSError("disk")
        return writer(df)

    monkeypatch.setattr(versions, "_writer", failing)
    with pytest.raises(OSError):
        uptime_reports.run_detector_uptime(changed, tv.corridors(t), ctx)
    assert stored() == before
    monkeypatch.setattr(versions, "_writer", writer)
    uptime_reports.run_detector_uptime(changed, tv.corridors(t), ctx)
    after = stored()
    assert all(after[m] != before[m] for m in marts)


COUNTS = ["signalid", "timeperiod", "eventparam", "CallPhase"]


def event_lake(spark, small, root, days):
    t = tv.Tables(spark, small)
    rows = tv.event_log(t).withColumn("signalid", F.col("signalid") % 5).withColumn("Date", F.to_date("timestamp"))
    sinks.write_by_date(rows.where(F.col("Date").isin([F.lit(d) for d in days])), root, "atspm")


def outputs(spark, root):
    return {n: values(df := versions.read_table(spark, root, n), *sorted(df.columns)) for n in ("comm_uptime", "counts_1hr", "filtered_counts_1hr")}


def test_lost_dates_are_continued_alone(spark, small, tmp_path, monkeypatch):
    t = tv.Tables(spark, small)
    config = tv.det_config(t).withColumn("signalid", F.col("signalid") % 5).dropDuplicates(["signalid", "eventparam"])
    lake_root = str(tmp_path / "lake")
    ctx = RunContext(day(0), day(9), day(10), root=str(tmp_path / "out"), thresholds=tv.THRESHOLDS)

    def run():
        return counts_jobs.continue_counts(spark, lake_root, "atspm", config, ctx)

    event_lake(spark, small, lake_root, [day(n) for n in (0, 1, 2, 4, 6, 7, 8, 9, 20)])
    assert run() == [(day(0), day(2)), (day(4), day(4)), (day(6), day(9))]  # not what lies beyond the run
    assert run() == []
    event_lake(spark, small, lake_root, [day(3), day(5)])
    before = outputs(spark, ctx.root)
    written = []
    monkeypatch.setattr(versions, "publish", lambda *a: written.append(a) or (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        run()
    monkeypatch.undo()
    assert written and outputs(spark, ctx.root) == before  # written, not published
    assert run() == [(day(3), day(3)), (day(5), day(5))]
    assert run() == []
    whole = replace(ctx, root=str(tmp_path / "whole"))
    assert counts_jobs.continue_counts(spark, lake_root, "atspm", config, whole) == [(day(0), day(9))]
    assert outputs(spark, whole.root) == outputs(spark, ctx.root)
    event_lake(spark, small, lake_root, [day(3)])
    versions.reopen(spark, ctx.root, [(day(3), day(3))])
    assert run() == [(day(3), day(3))] and outputs(spark, whole.root) == outputs(spark, ctx.root)
    # every day on its own: the same as one run of each day
    one = ops.filtered_counts(ops.detector_counts(lake.events_of(spark, lake_root, "atspm", [(day(7), day(7))]), config), thresholds=tv.THRESHOLDS)
    got = versions.read_table(spark, ctx.root, "filtered_counts_1hr").where(F.col("date") == F.lit(day(7)))
    assert values(got, "SignalID", "Timeperiod", "Detector", "delta_vol", "flatlined", "Good_Day") == values(
        one.withColumns({"signalid": F.col("signalid").cast("string"), "eventparam": F.col("eventparam").cast("string")}),
        "signalid", "timeperiod", "eventparam", "delta_vol", "flatlined", "Good_Day")


def test_one_scan_of_the_events(spark, small, tmp_path):
    t = tv.Tables(spark, small)
    tv.event_log(t).write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    scans = spark.sparkContext.accumulator(0)

    def count(x):
        scans.add(1)
        return x

    seen = F.udf(count, "bigint").asNondeterministic()
    ctx = RunContext(day(0), day(29), day(30), root=str(tmp_path / "out"), thresholds=tv.THRESHOLDS)
    counts_jobs.run_counts(events.withColumn("signalid", seen("signalid")), tv.det_config(t), ctx)
    assert scans.value == events.count()


def test_masks_equal_gaps_between_stamps(spark):
    rng = random.Random(8)
    rows = [(at(f"2024-01-0{rng.randint(1, 3)} 00:00") + dt.timedelta(seconds=rng.choice([rng.randrange(86400), 0, 86399])), rng.choice([1, 2, 3, None]), rng.choice([82, 81]), rng.choice([5, None])) for _ in range(250)]
    rows += [(None, 1, 82, 5), (at("2024-01-02 10:00:00"), 9, 82, 5), (at("2024-01-02 10:15:59"), 9, 1, 5), (at("2024-01-02 10:32:00"), 9, 1, 5)]
    events = spark.createDataFrame(rows, "timestamp timestamp_ntz, signalid bigint, eventcode int, eventparam int")
    end = dt.datetime(2024, 1, 4, 23, 59)

    def plain(signals, ends):
        out = {}
        stamps = {(s, t.replace(second=0, microsecond=0)) for t, s, _, _ in rows if t and s is not None}
        ids = {s for s, _ in stamps}
        stamps |= {(s, e) for s in ids for e in ends} if ends else {(s, dt.datetime.combine(t.date(), x)) for s, t in stamps for x in (dt.time(), dt.time(23, 59))}
        keyed = {}
        for s, t in stamps:
            keyed.setdefault((s, t.date()) if signals else (t.date(),), set()).add(t)
        for key, times in keyed.items():
            times = sorted(times)
            gaps = [(b - a).total_seconds() / 60 for a, b in zip(times, times[1:])]
            out[key] = 1 - sum(g for g in gaps if g > 15) / 1440
        return sorted((*k, v) for k, v in out.items())

    ranged = uptime.comm_uptime(events, day(0), end)
    ends = [dt.datetime(2024, 1, 1), end]
    assert values(ranged["sig"], "SignalID", "Date", "uptime") == plain(True, ends)
    assert values(ranged["all"], "Date", "uptime_all") == plain(False, ends)
    for units in ("hours", "15min"):
        staged = activity.signal_activity(events, units)
        alone = activity.uptime_of(activity.hour_masks(staged))
        assert values(alone["sig"], "SignalID", "Date", "uptime") == plain(True, [])
        assert values(alone["all"], "Date", "uptime_all") == plain(False, [])
        assert values(activity.activity_counts(staged), "timeperiod", "signalid", "eventparam", "vol") == values(
            ops.period_counts(events, units), "timeperiod", "signalid", "eventparam", "vol")


def test_merged_batches_count_once(spark, small, tmp_path, monkeypatch):
    t = tv.Tables(spark, small)
    events = tv.event_log(t).withColumn("signalid", F.col("signalid") % 20)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    config = tv.det_config(t)
    columns = [*COUNTS, "vol"]

    def run():
        stream = counts_stream.event_stream(spark, source, events.schema, 1)
        counts_stream.run_available(stream, out, state, merge_every=2).awaitTermination()

    for part in range(5):
        events.where(F.pmod(F.hash("timestamp"), F.lit(5)) == part).repartition(2).write.mode("append").parquet(source)
        if part == 2:  # the merge has written the base, but its state is not published
            monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(OSError("no")))
            with pytest.raises(Exception, match="no"):
                run()
            monkeypatch.undo()
            expected = counts_stream.streamed_counts(spark, out, config)
            assert expected.count() > 0
        run()
        arrived = ops.detector_counts(events.where(F.pmod(F.hash("timestamp"), F.lit(5)) <= part), config)
        assert values(counts_stream.streamed_counts(spark, out, config), *columns) == values(arrived, *columns)
        assert counts_stream.folders_read(spark, out) <= 4
    last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    (last.parent / f".{last.name}.crc").unlink()
    last.unlink()  # the last batch runs again after its merge
    run()
    assert values(counts_stream.streamed_counts(spark, out, config), *columns) == values(ops.detector_counts(events, config), *columns)
    assert len(versions.names_in(spark, f"{out}/deltas")) <= 3
    assert counts_stream.merge(spark, out) in (0, 1) and counts_stream.merge(spark, out) == 0
    assert values(counts_stream.streamed_counts(spark, out, config), *columns) == values(ops.detector_counts(events, config), *columns)


def test_base_stays_in_few_versions(spark, tmp_path):
    schema = "timestamp timestamp_ntz, signalid bigint, eventcode int, eventparam bigint"
    config = spark.createDataFrame([(1, 1, 2)], "signalid bigint, eventparam bigint, CallPhase bigint")
    out = str(tmp_path / "out")
    for n in range(7):
        rows = spark.createDataFrame([(at("2024-01-01 10:00") + dt.timedelta(days=n), 1, 82, 1)], schema)
        part = ops.period_counts(rows).withColumn("date", F.to_date("timeperiod"))
        part.write.partitionBy("date").parquet(f"{out}/deltas/batch={n}")
        counts_stream.merge(spark, out, n, most_versions=3)
        assert counts_stream.folders_read(spark, out) <= 3
    assert counts_stream.streamed_counts(spark, out, config).count() == 7
    assert counts_stream.streamed_counts(spark, str(tmp_path / "none"), config).count() == 0


def test_dates_come_from_the_listing(spark, tmp_path):
    folder = tmp_path / "t"
    for name in ("date=2024-01-03", "date=2024-01-01", "date=x", "month=2024-01-01", "_SUCCESS"):
        (folder / name).mkdir(parents=True)
        (folder / name / "broken.parquet").write_text("not a data file")
    assert lake.listed_dates(spark, str(folder)) == [day(0), day(2)]
    assert lake.listed_dates(spark, str(tmp_path / "none")) == []
    spark.sql(f"CREATE TABLE listed_t (x INT, date DATE) USING parquet PARTITIONED BY (date) LOCATION '{folder}'")
    try:
        assert catalog.sync_dates(spark, "listed_t", day(0), day(1)) == 1 and catalog.sync_dates(spark, "listed_t", day(0), day(9)) == 1
    finally:
        spark.sql("DROP TABLE listed_t")
