"""Uptime and report queries."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.context import RunContext, scratch_path
from corridor_metrics.operators import counts, filters, uptime
from corridor_metrics.operators.activity import signal_activity
from corridor_metrics.operators.counts import detector_counts
from corridor_metrics.operators.filters import report_names
from corridor_metrics.operators.marts import dashboard_slices, query_mart
from corridor_metrics.plans import camera_jobs, counts_jobs, uptime_reports
from corridor_metrics.registry import register
from corridor_metrics.registry.rollups import DELTA

FIRST, LAST = dt.date(2024, 1, 1), dt.datetime(2024, 1, 30, 23, 59)
TODAY = dt.date(2024, 1, 30)
RUN = RunContext(FIRST, LAST.date(), dt.date(2024, 1, 31), thresholds=tv.THRESHOLDS)

STAMPS = """
    WITH m AS (SELECT DISTINCT signalid AS SignalID, date_trunc('minute', "timestamp") AS ts FROM event_log),
    b AS (SELECT * FROM m UNION SELECT SignalID, TIMESTAMP '2024-01-01 00:00:00' FROM m
          UNION SELECT SignalID, TIMESTAMP '2024-01-30 23:59:00' FROM m)"""
SPAN = "epoch(ts - lag(ts) OVER (PARTITION BY {k} ORDER BY ts)) / 60"


@register("d14_comm_uptime_by_signal", "SignalID,Date:d,uptime:r",
          STAMPS.strip() + ", g AS (SELECT SignalID, CAST(ts AS DATE) AS Date, " + SPAN.format(k="SignalID, CAST(ts AS DATE)") + """ AS span FROM b)
---
SELECT SignalID, Date, 1 - sum(CASE WHEN span > 15 THEN span ELSE 0 END) / 1440 AS uptime FROM g GROUP BY ALL""", "event_log")
def d14(t):
    return uptime.comm_uptime(tv.event_log(t), FIRST, LAST)["sig"]


@register("d14_comm_uptime_all_signals", "Date:d,uptime_all:r",
          STAMPS.strip() + ", a AS (SELECT DISTINCT ts FROM b), g AS (SELECT CAST(ts AS DATE) AS Date, " + SPAN.format(k="CAST(ts AS DATE)") + """ AS span FROM a)
---
SELECT Date, 1 - sum(CASE WHEN span > 15 THEN span ELSE 0 END) / 1440 AS uptime_all FROM g GROUP BY ALL""", "event_log")
def d14b(t):
    return uptime.comm_uptime(tv.event_log(t), FIRST, LAST)["all"]


@register("e11_gap_spans", "SignalID,Timestamp,Date:d,span:r",
          """WITH b AS (SELECT DISTINCT signalid AS SignalID, date_trunc('minute', "timestamp") AS ts FROM event_log),
             g AS (SELECT SignalID, ts, """ + SPAN.format(k="SignalID, CAST(ts AS DATE)") + """ AS span FROM b)
---
SELECT SignalID, ts AS Timestamp, CAST(ts AS DATE) AS Date, CASE WHEN span > 15 THEN span ELSE 0 END AS span FROM g""", "event_log")
def e11(t):
    from corridor_metrics.functions.columns import floor_minutes

    stamps = tv.event_log(t).select(F.col("signalid").alias("SignalID"), floor_minutes("timestamp", 1).alias("Timestamp")).distinct()
    return uptime.gap_spans(stamps.withColumn("Date", F.to_date("Timestamp")), ["SignalID", "Date"])


@register("i05_counts_job_comm_uptime", "SignalID,Date:d,uptime:r",
          STAMPS.strip() + ", g AS (SELECT SignalID, CAST(ts AS DATE) AS Date, " + SPAN.format(k="SignalID, CAST(ts AS DATE)") + """ AS span FROM b)
---
SELECT SignalID, Date, 1 - sum(CASE WHEN span > 15 THEN span ELSE 0 END) / 1440 AS uptime FROM g GROUP BY ALL""", "event_log")
def i05(t):
    return counts_jobs.counts_outputs(signal_activity(tv.event_log(t)), tv.det_config(t), RUN)["comm_uptime"]


@register("d15_camera_size_spread", "CameraID,Date:d,Size:r",
          "SELECT CameraID, Date, coalesce(stddev_samp(Size), 0) AS Size FROM camera_images GROUP BY ALL", "camera_images", digits=3)
def d15(t):
    return uptime.camera_size_spread(camera_jobs.camera_log(tv.camera_log(t)))


@register("g19_camera_job", "CameraID,Date:d,Size:r",
          """SELECT CameraID, Date, coalesce(stddev_samp(Size), 0) AS Size FROM camera_images
             WHERE Date <> DATE '2024-01-30' GROUP BY ALL""", "camera_images", digits=3)
def g19(t):
    return camera_jobs.camera_uptime(tv.camera_log(t), TODAY)


@register("g19_encoder_job", "CameraID,Date:d,Size:r",
          """SELECT CameraID, Date, coalesce(stddev_samp(Size), 0) AS Size FROM camera_images
             WHERE Date <> DATE '2024-01-30' GROUP BY ALL""", "camera_images", digits=3)
def g19b(t):
    return camera_jobs.camera_uptime(tv.encoder_log(t), TODAY, encoders=True)


@register("b13_without_today", "CameraID,Datetime,Size,date:d",
          """SELECT 'CAM-' || user_id AS CameraID, strftime(ts, '%Y-%m-%d %H:%M:%S') AS Datetime,
             CAST(floor(value * 100) AS BIGINT) AS Size, CAST(ts AS DATE) AS date FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-30'""")
def b13(t):
    return filters.before_today(tv.encoder_log(t), TODAY)


@register("s05_http_date_to_local", "CameraID,Timestamp,Size,Date:d", "SELECT * FROM camera_images", "camera_images")
def s05(t):
    return camera_jobs.camera_log(tv.camera_log(t))


@register("s06_utc_text_to_local", "CameraID,Timestamp,Size,Date:d", "SELECT * FROM camera_images", "camera_images")
def s06(t):
    return camera_jobs.encoder_log(tv.encoder_log(t))


@register("d16_daily_detector_uptime", "SignalID,Date:d,uptime:r",
          "SELECT SignalID, Date, avg(uptime) AS uptime FROM daily_metric GROUP BY ALL", "daily_metric")
def d16(t):
    return uptime.daily_detector_uptime(tv.daily_metric(t))


PAPD = """papd AS (SELECT SignalID, Date, isodow(Date) - 1 AS DOW, weekofyear(Date) AS Week, Detector, CallPhase, sum(vol) AS papd
    FROM {src} WHERE CallPhase IS NOT NULL GROUP BY ALL)"""


@register("d17_daily_ped_activations", "SignalID,Date:d,DOW,Week,Detector,CallPhase,papd:i",
          "WITH " + PAPD.format(src="report_counts") + "\n---\nSELECT * FROM papd", "report_counts")
def d17(t):
    return counts.daily_ped_activations(tv.report_counts(t))


def presses(t):
    """Sparse ped presses: hourly click counts of the event log."""
    hourly = report_names(detector_counts(tv.event_log(t), tv.det_config(t), "hours"))
    return hourly.withColumn("Date", F.to_date("Timeperiod"))


PAU = """WITH c AS (SELECT signalid AS SignalID, eventparam AS Detector, CallPhase, CAST("timestamp" AS DATE) AS Date, count(*) AS vol
        FROM event_log JOIN det_config USING (signalid, eventparam) WHERE eventcode = 82 GROUP BY ALL),
    """ + PAPD.format(src="c") + """,
    k AS (SELECT DISTINCT SignalID, Detector, CallPhase FROM papd),
    cal AS (SELECT CAST(unnest(generate_series(DATE '{start}', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS Date),
    u AS (SELECT k.*, cal.Date, p.papd, CASE WHEN coalesce(p.papd, 0) > 0 THEN 1.0 ELSE 0.0 END AS uptime, 1 AS "all"
          FROM k CROSS JOIN cal LEFT JOIN papd p ON p.SignalID = k.SignalID AND p.Detector = k.Detector
               AND p.CallPhase = k.CallPhase AND p.Date = cal.Date),
    r AS (SELECT SignalID, Detector, CallPhase, Date, uptime, "all",
                 coalesce(CASE WHEN uptime = 1 THEN papd END, floor(avg(CASE WHEN uptime = 1 THEN papd END)
                   OVER (PARTITION BY SignalID, Detector, CallPhase, year(Date), month(Date)))) AS papd FROM u)"""


@register("i03_ped_uptime_rule", "SignalID,Detector,CallPhase,Date:d,papd:i,uptime:r,all",
          PAU.format(start="2024-01-01") + "\n---\nSELECT * FROM u", "event_log det_config")
def i03(t):
    return uptime.ped_uptime(counts.daily_ped_activations(presses(t)), FIRST, LAST.date())


@register("e06_ped_volume_repair", "SignalID,Detector,CallPhase,Date:d,papd:r,uptime:r,all",
          PAU.format(start="2024-01-01") + "\n---\nSELECT * FROM r", "event_log det_config")
def e06(t):
    return uptime.repair_ped_volumes(uptime.ped_uptime(counts.daily_ped_activations(presses(t)), FIRST, LAST.date()))


@register("b11_low_uptime_rows", "SignalID,Detector,CallPhase,Date:d,papd:r,uptime:r,all",
          PAU.format(start="2024-01-01") + "\n---\nSELECT * FROM r WHERE uptime < 0.5 AND Date >= DATE '2024-01-10'", "event_log det_config")
def b11(t):
    return filters.low_uptime(e06(t), dt.date(2024, 1, 10))


@register("g13_ped_report_corridor_monthly", "Zone_Group,Zone,Corridor,Month:d,uptime:r,all:r,delta:r",
          PAU.format(start="2023-07-01") + """,
    d AS (SELECT SignalID, Date, sum(uptime * "all") / sum("all") AS uptime, sum("all") AS w FROM r GROUP BY ALL),
    m AS (SELECT SignalID, CAST(date_trunc('month', Date) AS DATE) AS Month, sum(uptime * w) / sum(w) AS uptime, sum(w) AS w FROM d GROUP BY ALL),
    a AS (SELECT Zone_Group, Zone, Corridor, Month, sum(uptime * w) / sum(w) AS uptime, sum(w) AS "all"
          FROM m JOIN corridors USING (SignalID) WHERE Corridor IS NOT NULL GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Month") + " FROM a",
          "event_log det_config corridors")
def g13(t):
    pau = uptime_reports.ped_pushbutton_uptime(presses(t), RUN)
    return uptime_reports.ped_pushbutton_marts(pau, tv.corridors(t))["cor", "mo"]


@register("g12_detector_uptime_report_subcorridor_monthly", "Zone_Group,Zone,Corridor,Month:d,uptime:r,ones:r,delta:r",
          """WITH d AS (SELECT SignalID, Date, avg(uptime) AS uptime FROM daily_metric GROUP BY ALL),
             s AS (SELECT SignalID, Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor FROM corridors
                   WHERE Subcorridor IS NOT NULL AND Corridor IS NOT NULL AND Zone IS NOT NULL),
             a AS (SELECT Zone_Group, Zone, Corridor, CAST(date_trunc('month', Date) AS DATE) AS Month,
                          sum(uptime) / count(*) AS uptime, count(*) AS ones FROM d JOIN s USING (SignalID) GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Month") + " FROM a",
          "daily_metric corridors")
def g12(t):
    return uptime_reports.detector_uptime_marts(tv.daily_metric(t), tv.corridors(t))["sub", "mo"]


@register("g12_detector_uptime_report_signal_weekly", "SignalID,Week:d,uptime:r,ones:r,delta:r",
          """WITH d AS (SELECT SignalID, Date, avg(uptime) AS uptime FROM daily_metric GROUP BY ALL),
             a AS (SELECT SignalID, CAST(date_trunc('week', Date) AS DATE) AS Week, sum(uptime) / count(*) AS uptime,
                   count(*) AS ones FROM d GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY SignalID ORDER BY Week") + " FROM a", "daily_metric")
def g12b(t):
    return uptime_reports.detector_uptime_marts(tv.daily_metric(t), tv.corridors(t))["sig", "wk"]


REPORT = RunContext(dt.date(1996, 3, 1), dt.date(1997, 12, 31), dt.date(1998, 1, 1), wk_calcs_start_date=dt.date(1996, 2, 14))
DU = {"table": "du"}
REPORT_SQL = """WITH d AS (SELECT SignalID, Date, avg(uptime) AS uptime FROM daily_metric
        WHERE Date BETWEEN DATE '1996-02-01' AND DATE '1997-12-31' GROUP BY ALL),
    w AS (SELECT SignalID, CAST(date_trunc('week', Date) AS DATE) AS Date, avg(uptime) AS uptime, count(*) AS ones FROM (
            SELECT SignalID, Date, avg(uptime) AS uptime FROM daily_metric
            WHERE Date BETWEEN DATE '1996-02-01' AND DATE '1997-12-31' GROUP BY ALL) GROUP BY ALL),
    place AS (SELECT * FROM corridors WHERE Zone IS NOT NULL AND Corridor IS NOT NULL),
    subs AS (SELECT SignalID, Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor FROM place WHERE Subcorridor IS NOT NULL)"""


def report_root(t):
    """The nine marts of detector uptime, written by the job."""
    root = scratch_path(t.spark, "report")
    uptime_reports.run_detector_uptime(tv.daily_metric(t), tv.corridors(t), replace(REPORT, root=root))
    return root


@register("g12_job_then_read_signal_weekly", "SignalID,Date:d,uptime:r,ones:r,delta:r,Zone_Group,Zone,Corridor,Subcorridor",
          REPORT_SQL + ", x AS (SELECT *, " + DELTA.format(v="uptime", w="PARTITION BY SignalID ORDER BY Date") + """ FROM w)
---
SELECT x.*, Zone_Group, Zone, Corridor, Subcorridor FROM x JOIN corridors USING (SignalID)
WHERE Zone_Group = 'RTOP1' AND Date BETWEEN DATE '1996-02-12' AND DATE '1997-05-31'""", "daily_metric corridors")
def g12c(t):
    return query_mart(t.spark, report_root(t), DU, "signal", "weekly", zone_group="RTOP1", month=dt.date(1997, 5, 1))


CORRIDOR_WEEKS = REPORT_SQL + """, a AS (SELECT Zone_Group, Zone, Corridor, Date, avg(uptime) AS uptime, count(*) AS ones
        FROM w JOIN place USING (SignalID) GROUP BY ALL),
    x AS (SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Date") + " FROM a)\n---\n"


@register("g12_job_then_read_corridor_weekly", "Zone_Group,Zone,Corridor,Date:d,uptime:r,ones:r,delta:r",
          CORRIDOR_WEEKS + """SELECT * FROM x WHERE Zone_Group = 'RTOP1' AND Date BETWEEN DATE '1996-02-12' AND DATE '1997-05-31'""",
          "daily_metric corridors")
def g12d(t):
    return query_mart(t.spark, report_root(t), DU, "corridor", "weekly", zone_group="RTOP1", month=dt.date(1997, 5, 1))


@register("g12_job_then_read_corridor_monthly", "Zone_Group,Zone,Corridor,Month:d,uptime:r,ones:r,delta:r",
          REPORT_SQL + """, a AS (SELECT Zone_Group, Zone, Corridor, CAST(date_trunc('month', Date) AS DATE) AS Month,
        avg(uptime) AS uptime, count(*) AS ones FROM d JOIN place USING (SignalID) GROUP BY ALL),
    x AS (SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Month") + """ FROM a)
---
SELECT * FROM x WHERE Zone_Group = 'RTOP1' AND Month BETWEEN DATE '1996-03-01' AND DATE '1997-05-01'""", "daily_metric corridors")
def g12e(t):
    return query_mart(t.spark, report_root(t), DU, zone_group="RTOP1", month=dt.date(1997, 5, 1))


@register("g12_job_then_read_signal_monthly", "SignalID,Month:d,uptime:r,ones:r,delta:r,Zone_Group,Zone,Corridor,Subcorridor",
          REPORT_SQL + """, a AS (SELECT SignalID, CAST(date_trunc('month', Date) AS DATE) AS Month, avg(uptime) AS uptime,
        count(*) AS ones FROM d GROUP BY ALL),
    x AS (SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY SignalID ORDER BY Month") + """ FROM a)
---
SELECT x.*, Zone_Group, Zone, Corridor, Subcorridor FROM x LEFT JOIN corridors USING (SignalID)
WHERE Month BETWEEN DATE '1996-03-01' AND DATE '1997-05-01'""", "daily_metric corridors")
def g12f(t):
    return query_mart(t.spark, report_root(t), DU, "signal", zone_group="All", month=dt.date(1997, 5, 1))


@register("g12_job_then_read_subcorridor_daily", "Zone_Group,Zone,Corridor,Date:d,uptime:r,ones:r,delta:r",
          REPORT_SQL + """, a AS (SELECT Zone_Group, Zone, Corridor, Date, avg(uptime) AS uptime, count(*) AS ones
        FROM d JOIN subs USING (SignalID) GROUP BY ALL),
    x AS (SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Date") + """ FROM a)
---
SELECT * FROM x WHERE Zone_Group = 'Zone 2' AND Date BETWEEN DATE '1996-03-01' AND DATE '1997-05-31'""", "daily_metric corridors")
def g12g(t):
    return query_mart(t.spark, report_root(t), DU, "subcorridor", "daily", zone_group="Zone 2", month=dt.date(1997, 5, 1))


@register("g07_dashboard_of_job_marts", "Corridor,Date:d,var:r,col",
          CORRIDOR_WEEKS + """SELECT Corridor, Date, uptime AS var, 1 AS col FROM x
             WHERE Zone_Group = 'RTOP1' AND Date >= DATE '1996-02-12' AND Date < DATE '1997-05-31'""", "daily_metric corridors")
def g07d(t):
    root, month = report_root(t), dt.date(1997, 5, 1)
    weekly = query_mart(t.spark, root, DU, resolution="weekly", zone_group="RTOP1", month=month)
    monthly = query_mart(t.spark, root, DU, zone_group="RTOP1", month=month)
    return dashboard_slices(weekly, monthly, "uptime", month, "RTOP1", "red")["week"]


PERIOD = {"dy": ("daily", "Date", "Date"), "wk": ("weekly", "Week", "CAST(date_trunc('week', Date) AS DATE)"),
          "mo": ("monthly", "Month", "CAST(date_trunc('month', Date) AS DATE)")}
PLACES = """place AS (SELECT * FROM corridors WHERE Zone IS NOT NULL AND Corridor IS NOT NULL),
    subs AS (SELECT SignalID, Zone AS Zone_Group, Corridor AS Zone, Subcorridor AS Corridor FROM place WHERE Subcorridor IS NOT NULL)"""


def mart_sql(head: str, per: str, level: str, rows: str, weight: str) -> tuple[str, str]:
    """Columns and statement of a mart from signal rows with the period, ``uptime`` and a weight."""
    name = PERIOD[per][1]
    if level == "sig":
        keys, source = ["SignalID"], rows
    else:
        keys, source = ["Zone_Group", "Zone", "Corridor"], f"{rows} JOIN {'place' if level == 'cor' else 'subs'} USING (SignalID)"
    names = ", ".join(keys)
    body = f"""{head}, {PLACES}, a AS (SELECT {names}, {name}, sum(uptime * "{weight}") / sum("{weight}") AS uptime,
        sum("{weight}") AS "{weight}" FROM {source} GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w=f"PARTITION BY {names} ORDER BY {name}") + " FROM a"
    return f"{','.join(keys)},{name}:d,uptime:r,{weight}:r,delta:r", body


def register_detector_marts():
    for level, long in (("sig", "signal"), ("cor", "corridor"), ("sub", "subcorridor")):
        for per, (word, name, slot) in PERIOD.items():
            if (level, per) in (("sub", "mo"), ("sig", "wk")):
                continue  # registered above
            head = "WITH d AS (SELECT SignalID, Date, avg(uptime) AS uptime, 1 AS ones FROM daily_metric GROUP BY ALL)"
            rows = f"(SELECT SignalID, {slot} AS {name}, uptime, ones FROM d)"
            if per == "wk":
                rows = f"(SELECT SignalID, {slot} AS Week, avg(uptime) AS uptime, 1 AS ones FROM d GROUP BY ALL)"
            columns, sql = mart_sql(head, per, level, rows, "ones")
            if (level, per) == ("sig", "dy"):
                columns, sql = "SignalID,Date:d,uptime:r", head + "\n---\nSELECT SignalID, Date, uptime FROM d"

            def query(t, key=(level, per)):
                return uptime_reports.detector_uptime_marts(tv.daily_metric(t), tv.corridors(t))[key]

            register(f"g12_detector_uptime_report_{long}_{word}", columns, sql, "daily_metric corridors")(query)


def register_ped_marts():
    for level, long in (("sig", "signal"), ("cor", "corridor"), ("sub", "subcorridor")):
        for per, (word, name, slot) in PERIOD.items():
            if (level, per) == ("cor", "mo"):
                continue  # registered above
            weight = "all" if per == "mo" else "ones"
            head = PAU.format(start="2023-07-01") + """,
    d AS (SELECT SignalID, Date, avg(uptime) AS uptime, count(*) AS ones, sum("all") AS "all" FROM r GROUP BY ALL)"""
            rows = f'(SELECT SignalID, {slot} AS {name}, uptime, "{weight}" FROM d)'
            if per == "wk":
                rows = f"(SELECT SignalID, {slot} AS Week, avg(uptime) AS uptime, count(*) AS ones FROM d GROUP BY ALL)"
            columns, sql = mart_sql(head, per, level, rows, weight)

            def query(t, key=(level, per)):
                pau = uptime_reports.ped_pushbutton_uptime(presses(t), RUN)
                return uptime_reports.ped_pushbutton_marts(pau, tv.corridors(t))[key]

            register(f"g13_ped_report_{long}_{word}", columns, sql, "event_log det_config corridors")(query)


register_detector_marts()
register_ped_marts()
