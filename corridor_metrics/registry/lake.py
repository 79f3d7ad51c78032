"""Source, sink, catalog and streaming queries: written and read back in the shared folder."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.functions.columns import path_date
from corridor_metrics.context import scratch_path
from corridor_metrics.operators.filters import low_uptime
from corridor_metrics.plans import camera_jobs, counts_jobs, travel_jobs, uptime_reports
from corridor_metrics.registry import register
from corridor_metrics.registry.counts import RUN
from corridor_metrics.registry.travel import TIMES, TIME_COLUMNS
from corridor_metrics.registry.uptime import PAU, TODAY, presses
from corridor_metrics.sources import catalog, lake, sinks, versions
from corridor_metrics.streaming import counts_stream, reactive

START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 20)


def fresh(t, name="lake"):
    return scratch_path(t.spark, name)


def daily_events(t):
    return tv.event_log(t).withColumn("Date", F.to_date("timestamp"))


def event_lake(t, table="atspm"):
    """The event log as a date-partitioned table; returns its root."""
    root = fresh(t)
    sinks.write_by_date(daily_events(t), root, table)
    return root


@register("a01_read_one_object", "eventcode,eventparam,signalid,timestamp,Date:d",
          """SELECT eventcode, eventparam, signalid, "timestamp", CAST("timestamp" AS DATE) AS Date FROM event_log
             WHERE CAST("timestamp" AS DATE) = DATE '2024-01-09'""", "event_log")
def a01(t):
    root = fresh(t)
    sinks.write_by_date(daily_events(t).withColumn("__index", F.lit(0)), root, "atspm")
    return lake.read_object(t.spark, f"{root}/atspm/date=2024-01-09")


@register("a02_read_date_range", "eventcode,eventparam,signalid,timestamp,Date:d",
          """SELECT eventcode, eventparam, signalid, "timestamp", CAST("timestamp" AS DATE) AS Date FROM event_log
             WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND eventcode = 82""", "event_log")
def a02(t):
    def hits(df):
        return df.where(F.col("eventcode") == 82)

    return lake.read_dates(t.spark, event_lake(t), "atspm", START, END, callback=hits)


@register("a03_write_one_date", "SignalID,Detector,CallPhase,Timeperiod,vol,date:d",
          """SELECT CAST(SignalID AS VARCHAR) AS SignalID, CAST(Detector AS VARCHAR) AS Detector, CAST(CallPhase AS VARCHAR) AS CallPhase,
             Timeperiod, vol, Date AS date FROM report_counts WHERE Date = DATE '2024-01-07'""", "report_counts")
def a03(t):
    root, day = fresh(t), dt.date(2024, 1, 7)
    rows = tv.report_counts(t).where(F.col("Date") == F.lit(day))
    sinks.write_date(rows.withColumn("vol", F.col("vol") + 1), root, "counts_1hr", day)
    sinks.write_date(rows, root, "counts_1hr", day)
    return sinks.read_back(t.spark, root, "counts_1hr")


@register("a04_write_split_by_date", "SignalID,Detector,CallPhase,Timeperiod,vol,date:d",
          """SELECT CAST(SignalID AS VARCHAR) AS SignalID, CAST(Detector AS VARCHAR) AS Detector, CAST(CallPhase AS VARCHAR) AS CallPhase,
             Timeperiod, vol, Date AS date FROM report_counts""", "report_counts")
def a04(t):
    root = fresh(t)
    sinks.write_by_date(tv.report_counts(t).drop("Date"), root, "counts_1hr")
    return sinks.read_back(t.spark, root, "counts_1hr")


@register("a05_save_mart_from_date", "SignalID,Date:d,uptime:r,num:r",
          "SELECT * FROM daily_metric WHERE Date >= DATE '1997-01-01'", "daily_metric")
def a05(t):
    path = sinks.save_mart(tv.daily_metric(t), fresh(t), "sig", "dy", "du", dt.date(1997, 1, 1))
    return t.spark.read.parquet(path)


@register("a06_controller_event_scan", "timestamp,signalid,eventcode,eventparam",
          """SELECT * FROM event_log WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-21'
             AND eventcode IN (1, 82)""", "event_log")
def a06(t):
    path = fresh(t)
    tv.event_log(t).withColumnsRenamed({"timestamp": "Timestamp", "signalid": "SignalID"}).write.parquet(path)
    return lake.controller_events(t.spark, path, START, END, event_codes=[1, 82])


LAKE_COLUMNS = "timestamp,signalid,eventcode,eventparam,date:d"


@register("a07_lake_event_scan", LAKE_COLUMNS,
          """SELECT *, CAST("timestamp" AS DATE) AS date FROM event_log WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
             AND isodow("timestamp") IN (2, 3, 4) AND signalid IN (3, 5, 7, 11, 13)""", "event_log")
def a07(t):
    return lake.lake_events(t.spark, event_lake(t), "atspm", START, END, [3, 5, 7, 11, 13])


@register("a08_detection_event_scan", LAKE_COLUMNS,
          """SELECT *, CAST("timestamp" AS DATE) AS date FROM event_log WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
          "event_log")
def a08(t):
    return lake.detection_events(t.spark, event_lake(t, "DetectionEvents"), START, END)


@register("a09_csv_source", "SignalID,PrimaryName,SecondaryName,Latitude:r,Longitude:r", "SELECT * FROM intersections", "intersections")
def a09(t):
    path = fresh(t)
    tv.intersections(t).select("SignalID", "PrimaryName", "SecondaryName", "Latitude", "Longitude").write.csv(path, header=True)
    return lake.read_csv(t.spark, path, "intersections")


@register("a10_month_scan", LAKE_COLUMNS,
          """SELECT *, CAST(CAST("timestamp" AS DATE) + to_months(CAST(signalid % 3 AS INTEGER)) AS DATE) AS date FROM event_log
             WHERE month(CAST("timestamp" AS DATE) + to_months(CAST(signalid % 3 AS INTEGER))) = 2""", "event_log")
def a10(t):
    root = fresh(t)
    months = daily_events(t).withColumn("Date", F.add_months("Date", (F.col("signalid") % 3).cast("int")))
    sinks.write_by_date(months, root, "atspm")
    return lake.read_month(t.spark, root, "atspm", dt.date(2024, 2, 1))


def month_table(t):
    """A catalog table of orders by month over written files; returns its name."""
    root, name = fresh(t), f"mart_{uuid.uuid4().hex}"
    rows = tv.mart(t).select(
        "Zone_Group", "Corridor", F.col("Month").cast("timestamp_ntz").alias("Timeperiod"), F.col("tp").alias("var"), "Month"
    )
    sinks.write_by_month(rows.drop("Month"), root, "cor_mo_tp", "Timeperiod")
    t.spark.sql(
        f"""CREATE TABLE {name} (Zone_Group STRING, Corridor STRING, Timeperiod TIMESTAMP_NTZ, var DOUBLE, month DATE)
            USING parquet PARTITIONED BY (month) LOCATION '{root}/cor_mo_tp'"""
    )
    t.spark.sql(f"MSCK REPAIR TABLE {name}")
    return name


def shown(t, name):
    """The partitions of a table, which is then dropped from the catalog."""
    out = catalog.partitions(t.spark, name)
    out = t.spark.createDataFrame(out.collect(), out.schema)
    t.spark.sql(f"DROP TABLE {name}")
    return out


@register("a12_create_partitioned_mart", "partition:d",
          """SELECT DISTINCT CAST(unnest(generate_series(date_trunc('month', (SELECT max(o_orderdate) FROM orders)) - INTERVAL 10 MONTH,
             date_trunc('month', (SELECT max(o_orderdate) FROM orders)) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS partition""")
def a12(t):
    today = t.orders.agg(F.to_date(F.max("o_orderdate")).alias("d")).first()["d"]
    name = f"mart_{uuid.uuid4().hex}"
    catalog.create_mart_table(t.spark, name, fresh(t), today)
    return shown(t, name)


@register("a13_add_next_month", "partition:d",
          """SELECT DISTINCT Month AS partition FROM mart
             UNION SELECT CAST(date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH AS DATE) FROM orders""", "mart")
def a13(t):
    name = month_table(t)
    today = t.orders.agg(F.to_date(F.max("o_orderdate")).alias("d")).first()["d"]
    catalog.add_next_month(t.spark, name, today)
    catalog.add_next_month(t.spark, name, today)
    return shown(t, name)


@register("a14_drop_expired_months", "partition:d",
          """SELECT DISTINCT Month AS partition FROM mart
             WHERE Month > date_trunc('month', (SELECT max(o_orderdate) FROM orders)) - INTERVAL 8 MONTH""", "mart")
def a14(t):
    name = month_table(t)
    today = t.orders.agg(F.to_date(F.max("o_orderdate")).alias("d")).first()["d"]
    catalog.drop_expired(t.spark, name, today)
    return shown(t, name)


@register("a15_sync_date_partitions", "partition:d",
          """SELECT DISTINCT CAST(ts AS DATE) AS partition FROM events""")
def a15(t):
    root, name = fresh(t), f"atspm_{uuid.uuid4().hex}"
    sinks.write_by_date(daily_events(t).select("signalid", "Date"), root, "atspm")
    t.spark.sql(f"CREATE TABLE {name} (signalid BIGINT, date DATE) USING parquet PARTITIONED BY (date) LOCATION '{root}/atspm'")
    catalog.sync_dates(t.spark, name, dt.date(2024, 1, 1), dt.date(2024, 1, 5))
    catalog.sync_dates(t.spark, name, dt.date(2023, 12, 1), dt.date(2024, 2, 29))
    return shown(t, name)


@register("f03_missing_dates", "partition:d",
          """SELECT CAST(d AS DATE) AS partition FROM generate_series(DATE '2023-12-15', DATE '2024-02-15', INTERVAL 1 DAY) g(d)
             EXCEPT SELECT CAST(ts AS DATE) FROM events""")
def f03(t):
    existing = daily_events(t).select(F.col("Date").alias("partition"))
    return catalog.missing_dates(t.spark, existing, dt.date(2023, 12, 15), dt.date(2024, 2, 15))


@register("a16_latest_feed", "SignalID,PrimaryName,SecondaryName,Latitude:r,Longitude:r",
          "SELECT * FROM intersections", "intersections")
def a16(t):
    root = fresh(t)
    rows = tv.intersections(t).select("SignalID", "PrimaryName", "SecondaryName", "Latitude", "Longitude")
    older = rows.withColumn("Latitude", F.col("Latitude") + 1)
    older.write.csv(f"{root}/intersections_2024-01-01", header=True)
    rows.repartition(4).write.csv(f"{root}/intersections_2024-02-01", header=True)
    return lake.latest_feed(lake.read_csv(t.spark, f"{root}/*", "intersections"), root)


@register("a17_signals_from_paths", "date:d,SignalID",
          "SELECT DISTINCT CAST(ts AS DATE) AS date, user_id % 10 AS SignalID FROM events")
def a17(t):
    root = fresh(t)
    named = daily_events(t).withColumn("atspm", F.col("signalid") % 10).withColumnRenamed("Date", "date")
    named.hint("rebalance", "date", "atspm").write.partitionBy("date", "atspm").parquet(root)
    return lake.signals_in_paths(t.spark.read.parquet(root), "atspm=")


@register("a18_newest_file_time", "n,newer", "SELECT count(*) AS n, 'second' AS newer FROM orders")
def a18(t):
    """Two copies of a table; the rows are read from both, those of the copy with the newer files stay."""
    root = fresh(t)
    copies = []
    for name in ("first", "second"):
        t.orders.select("o_orderkey").write.parquet(f"{root}/{name}")
        stored = t.spark.read.parquet(f"{root}/{name}").select("o_orderkey", "_metadata.file_modification_time")
        newest = lake.freshness(t.spark.read.parquet(f"{root}/{name}")).withColumn("newer", F.lit(name))
        copies.append((stored.withColumn("newer", F.lit(name)), newest))
    times = copies[0][1].unionByName(copies[1][1])
    last = times.agg(F.max(F.struct("last_modified", "newer")).alias("m")).select("m.newer")
    return copies[0][0].unionByName(copies[1][0]).join(last, ["newer"]).groupBy("newer").agg(F.count("*").alias("n"))


@register("a19_file_manifest", "date:d,extension", "SELECT DISTINCT CAST(ts AS DATE) AS date, '.parquet' AS extension FROM events")
def a19(t):
    root = fresh(t)
    sinks.write_by_date(daily_events(t), root, "atspm")
    files = lake.manifest(t.spark, f"{root}/atspm", [".parquet"])
    return files.select(path_date("path").alias("date"), "extension").distinct()


@register("a20_watchdog_snapshot", "SignalID,Detector,CallPhase,Date:d,papd:r,uptime:r,all",
          PAU.format(start="2024-01-01") + "\n---\nSELECT * FROM r WHERE uptime < 0.5", "event_log det_config")
def a20(t):
    from corridor_metrics.registry.uptime import e06

    path = fresh(t, "watchdog")
    sinks.write_snapshot(low_uptime(e06(t)), path)
    return t.spark.read.parquet(path)


@register("a21_monthly_outputs", "CameraID,Date:d,Size:r,month:d",
          """SELECT CameraID, Date, coalesce(stddev_samp(Size), 0) AS Size, DATE '2024-01-01' AS month FROM camera_images
             WHERE Date <> DATE '2024-01-30' GROUP BY ALL""", "camera_images", digits=3)
def a21(t):
    root = fresh(t)
    table = camera_jobs.write_camera_uptime(tv.camera_log(t), root, TODAY)
    return sinks.read_back(t.spark, root, table)


@register("g18_travel_time_table", TIME_COLUMNS + ",date:d",
          "WITH x AS (" + TIMES + ")\n---\nSELECT *, CAST(Minute AS DATE) AS date FROM x", "readings segments")
def g18(t):
    root = fresh(t)
    travel_jobs.write_travel_times(tv.readings(t), tv.segments(t), root)
    return sinks.read_back(t.spark, root, "travel_times_1min")


@register("g14_counts_job_written", "SignalID,Timeperiod,Detector,CallPhase,vol,date:d",
          """WITH h AS (SELECT date_trunc('hour', "timestamp") AS timeperiod, signalid, eventparam, count(*) AS vol
                FROM event_log WHERE eventcode = 82 GROUP BY ALL)
---
SELECT CAST(h.signalid AS VARCHAR) AS SignalID, timeperiod AS Timeperiod, CAST(h.eventparam AS VARCHAR) AS Detector,
       CAST(CallPhase AS VARCHAR) AS CallPhase, vol, CAST(timeperiod AS DATE) AS date
FROM h LEFT JOIN det_config USING (signalid, eventparam)""", "event_log det_config")
def g14(t):
    from dataclasses import replace

    ctx = replace(RUN, root=fresh(t))
    counts_jobs.run_counts(tv.event_log(t), tv.det_config(t), ctx)
    return sinks.read_back(t.spark, ctx.root, "counts_1hr")


@register("g13_bad_ped_detectors_written", "SignalID,Detector,CallPhase,papd:r,uptime:r,all,date:d",
          PAU.format(start="2023-07-01") + """
---
SELECT CAST(SignalID AS VARCHAR) AS SignalID, CAST(Detector AS VARCHAR) AS Detector, CAST(CallPhase AS VARCHAR) AS CallPhase,
       papd, uptime, "all", Date AS date FROM r WHERE uptime < 0.5 AND Date >= DATE '2024-01-01'""", "event_log det_config")
def g13(t):
    from dataclasses import replace

    from corridor_metrics.registry.uptime import RUN as PED_RUN

    ctx = replace(PED_RUN, root=fresh(t))
    uptime_reports.run_ped_pushbutton_uptime(presses(t), tv.corridors(t), ctx)
    return sinks.read_back(t.spark, ctx.root, "bad_ped_detectors")


STREAMED = """SELECT h.*, d.CallPhase FROM (SELECT date_trunc('hour', "timestamp") AS timeperiod, {signal} AS signalid, eventparam,
    count(*) AS vol FROM event_log WHERE eventcode = 82 GROUP BY ALL) h LEFT JOIN det_config d ON h.signalid = d.signalid
    AND h.eventparam = d.eventparam"""


def streamed(t, events):
    """The later half of the month arrives first, in several files and batches; every third batch is merged."""
    root = fresh(t, "stream")
    half = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")

    def arrive(rows):
        rows.repartition(2).write.mode("append").parquet(f"{root}/in")
        stream = counts_stream.event_stream(t.spark, f"{root}/in", events.schema, files_per_trigger=1)
        counts_stream.run_available(stream, f"{root}/out", f"{root}/state", merge_every=3).awaitTermination()

    arrive(events.where(F.col("timestamp") >= half))
    arrive(events.where((F.col("timestamp") < half) | F.col("timestamp").isNull()))
    return counts_stream.streamed_counts(t.spark, f"{root}/out", tv.det_config(t)).drop("date")


def continued(t, lost):
    """The daily job over a lake that lacks some dates, again when they have come, and once more."""
    from dataclasses import replace

    lake_root, ctx = fresh(t), replace(RUN, root=fresh(t, "daily"))
    events = daily_events(t).where(F.col("Date").between(F.lit(RUN.start_date), F.lit(RUN.end_date)))
    late = F.col("Date").isin(*[F.lit(day) for day in lost])
    runs = []
    for rows in (events.where(~late), events.where(late), None):
        if rows is not None:
            sinks.write_by_date(rows, lake_root, "atspm")
        done = counts_jobs.continue_counts(t.spark, lake_root, "atspm", tv.det_config(t), ctx)
        runs.append([(len(runs) + 1, first, last) for first, last in done])
    return ctx, [span for run in runs for span in run]


LOST = (dt.date(2024, 1, 9), dt.date(2024, 1, 10), dt.date(2024, 1, 17))


@register("j02_continued_counts", "SignalID,Timeperiod,Detector,CallPhase,vol,date:d",
          """WITH h AS (SELECT date_trunc('hour', "timestamp") AS timeperiod, signalid, eventparam, count(*) AS vol
                FROM event_log WHERE eventcode = 82 GROUP BY ALL)
---
SELECT CAST(h.signalid AS VARCHAR) AS SignalID, timeperiod AS Timeperiod, CAST(h.eventparam AS VARCHAR) AS Detector,
       CAST(CallPhase AS VARCHAR) AS CallPhase, vol, CAST(timeperiod AS DATE) AS date
FROM h LEFT JOIN det_config USING (signalid, eventparam)
WHERE CAST(timeperiod AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'""".format(start=RUN.start_date, end=RUN.end_date), "event_log det_config")
def j02c(t):
    ctx, _ = continued(t, LOST)
    return versions.read_table(t.spark, ctx.root, "counts_1hr")


@register("j02_continued_spans", "run,first:d,last:d",
          """WITH d AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS day FROM event_log
                WHERE CAST("timestamp" AS DATE) BETWEEN DATE '{start}' AND DATE '{end}'),
          r AS (SELECT day, CASE WHEN day IN (DATE '2024-01-09', DATE '2024-01-10', DATE '2024-01-17') THEN 2 ELSE 1 END AS run FROM d),
          i AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY run ORDER BY day) AS INTEGER) AS island FROM r)
---
SELECT run, min(day) AS first, max(day) AS last FROM i GROUP BY run, island""".format(start=RUN.start_date, end=RUN.end_date), "event_log")
def j02d(t):
    _, spans = continued(t, LOST)
    return t.spark.createDataFrame(spans, "run int, first date, last date")


@register("j02_streamed_hourly_counts", "timeperiod,signalid,eventparam,CallPhase,vol", STREAMED.format(signal="signalid"),
          "event_log det_config")
def j02(t):
    return streamed(t, tv.event_log(t))


@register("j02_streamed_counts_of_few_signals", "timeperiod,signalid,eventparam,CallPhase,vol",
          STREAMED.format(signal="signalid % 20"), "event_log det_config")
def j02b(t):
    return streamed(t, tv.event_log(t).withColumn("signalid", F.col("signalid") % 20))


@register("j01_refresh_on_change", "SignalID,Zone_Group,Zone,Corridor,Subcorridor,Name", "SELECT * FROM corridors", "corridors")
def j01(t):
    root = fresh(t, "poll")
    corridors = tv.corridors(t)
    corridors.withColumn("Name", F.lit("before")).write.parquet(f"{root}/in")

    def poll():
        reactive.refresh(t.spark, f"{root}/in", corridors.schema, f"{root}/out")

    poll()
    half = F.col("SignalID") % 2 == 0
    corridors.where(half).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/in")
    poll()
    corridors.where(~half | half.isNull()).write.mode("append").parquet(f"{root}/in")
    poll()
    return reactive.current(t.spark, f"{root}/out")
