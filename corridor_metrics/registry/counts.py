"""Event, counts and quality-filter queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.context import RunContext
from corridor_metrics.operators import counts as ops
from corridor_metrics.operators import delays, filters, scale
from corridor_metrics.operators.activity import signal_activity
from corridor_metrics.plans import counts_jobs, signal_detail
from corridor_metrics.registry import register

START, END = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
RUN = RunContext(dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 1), thresholds=tv.THRESHOLDS)
EVENT = "timestamp,signalid,eventcode,eventparam"


@register("b01_events_half_open_range", EVENT,
          """SELECT * FROM event_log WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-21'
             AND eventcode IN (81, 82) AND isodow("timestamp") IN (2, 3, 4)""", "event_log")
def b01(t):
    return filters.events_between(tv.event_log(t), START, END, event_codes=[81, 82], twr_only=True)


@register("b01_events_of_listed_signals", EVENT,
          """SELECT * FROM event_log WHERE "timestamp" >= TIMESTAMP '2024-01-05' AND "timestamp" < TIMESTAMP '2024-01-21'
             AND signalid IN (SELECT SignalID FROM corridors WHERE Zone_Group = 'RTOP1')""", "event_log corridors")
def b01b(t):
    signals = tv.corridors(t).where(F.col("Zone_Group") == "RTOP1").select(F.col("SignalID").alias("signalid"))
    return filters.events_between(tv.event_log(t), START, END, signals)


@register("b02_dates_closed_range", "date:d," + EVENT,
          """SELECT CAST("timestamp" AS DATE) AS date, * FROM event_log
             WHERE CAST("timestamp" AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND isodow("timestamp") IN (2, 3, 4)""",
          "event_log")
def b02(t):
    return filters.dates_between(tv.event_log(t).withColumn("date", F.to_date("timestamp")), START, END)


@register("b03_whole_day_gate", "timeperiod,signalid,eventparam,CallPhase,vol",
          """WITH h AS (SELECT date_trunc('hour', "timestamp") AS timeperiod, signalid, eventparam, count(*) AS vol
                FROM event_log WHERE eventcode = 82 AND dayofweek("timestamp") IN (2, 3, 4) GROUP BY ALL)
---
SELECT h.*, CallPhase FROM h LEFT JOIN det_config USING (signalid, eventparam)""", "event_log det_config")
def b03(t):
    return ops.detector_counts(tv.event_log(t), tv.det_config(t), "hours", twr_only=True)


COUNTS = """
    WITH h AS (SELECT {slot} AS timeperiod, signalid, eventparam, count(*) AS vol
               FROM event_log WHERE eventcode = 82 GROUP BY ALL)
---
SELECT h.*, CallPhase FROM h LEFT JOIN det_config USING (signalid, eventparam)"""


@register("d10_detector_counts_hourly", "timeperiod,signalid,eventparam,CallPhase,vol",
          COUNTS.format(slot="""date_trunc('hour', "timestamp")"""), "event_log det_config")
def d10(t):
    return ops.detector_counts(tv.event_log(t), tv.det_config(t), "hours")


@register("d10_detector_counts_15min", "timeperiod,signalid,eventparam,CallPhase,vol",
          COUNTS.format(slot="""time_bucket(INTERVAL 15 MINUTE, "timestamp")"""), "event_log det_config")
def d10b(t):
    return ops.detector_counts(tv.event_log(t), tv.det_config(t), "15min")


@register("d10_detector_counts_of_few_signals", "timeperiod,signalid,eventparam,CallPhase,vol",
          """SELECT h.*, d.CallPhase FROM (SELECT date_trunc('hour', "timestamp") AS timeperiod, signalid % 20 AS signalid, eventparam,
             count(*) AS vol FROM event_log WHERE eventcode = 82 GROUP BY ALL) h LEFT JOIN det_config d
             ON h.signalid = d.signalid AND h.eventparam = d.eventparam""", "event_log det_config")
def d10c(t):
    dense = tv.event_log(t).withColumn("signalid", F.col("signalid") % 20)
    return ops.detector_counts(dense, tv.det_config(t), "hours")


@register("c02_join_detector_config", "signalid,timeperiod,eventparam,vol,CallPhase",
          """SELECT c.signalid, timeperiod, c.eventparam, vol, d.CallPhase
             FROM counts c LEFT JOIN det_config d ON c.signalid = d.signalid AND c.eventparam = d.eventparam""",
          "counts det_config")
def c02(t):
    return ops.with_phase(tv.counts(t).drop("CallPhase"), tv.det_config(t))


@register("d18_events_per_signal_hour", "SignalID,Timeperiod,queue_spillback_metric",
          """SELECT signalid AS SignalID, date_trunc('hour', "timestamp") AS Timeperiod, count(*) AS queue_spillback_metric
             FROM event_log GROUP BY ALL""", "event_log")
def d18(t):
    return ops.signal_event_counts(tv.event_log(t), "hour")


@register("i04_queue_spillback_15min", "SignalID,Timeperiod,queue_spillback_metric",
          """SELECT signalid AS SignalID, time_bucket(INTERVAL 15 MINUTE, "timestamp") AS Timeperiod,
             count(*) AS queue_spillback_metric FROM event_log GROUP BY ALL""", "event_log")
def i04(t):
    return ops.signal_event_counts(tv.event_log(t), "15min")


@register("g17_queue_spillback_outputs", "output,SignalID,Timeperiod,queue_spillback_metric",
          """SELECT 'queue_spillback' AS output, signalid AS SignalID, date_trunc('hour', "timestamp") AS Timeperiod,
                    count(*) AS queue_spillback_metric FROM event_log GROUP BY ALL
             UNION ALL
             SELECT 'queue_spillback_15min', signalid, time_bucket(INTERVAL 15 MINUTE, "timestamp"), count(*)
             FROM event_log GROUP BY ALL""", "event_log")
def g17(t):
    hour, quarter = (df.withColumn("output", F.lit(k)) for k, df in counts_jobs.queue_spillback(tv.event_log(t)).items())
    return hour.unionByName(quarter)


FLAT = """
    WITH s AS (SELECT *, lag(vol) OVER w AS prev FROM {src} WINDOW w AS (PARTITION BY signalid, CallPhase, eventparam ORDER BY timeperiod)),
    f AS (SELECT signalid, timeperiod, eventparam, CallPhase, vol, vol - prev AS delta_vol,
                 CASE WHEN CallPhase IS NOT NULL THEN
                   sum(CASE WHEN vol = prev THEN 1 ELSE 0 END) OVER (PARTITION BY signalid, CallPhase, eventparam ORDER BY timeperiod) END AS flatlined
          FROM s)"""
FLAGS = """
    SELECT *, coalesce(flatlined > {flat}, false) AS flat_flag, coalesce(vol > {top}, false) AS maxvol_flag,
           coalesce(abs(delta_vol) > {jump}, false) AS mad_flag,
           NOT (coalesce(flatlined > {flat}, false) OR coalesce(vol > {top}, false) OR coalesce(abs(delta_vol) > {jump}, false)) AS Good_Day
    FROM f"""
FLAG_COLUMNS = "signalid,timeperiod,eventparam,CallPhase,vol,delta_vol:i,flatlined:i,flat_flag,maxvol_flag,mad_flag,Good_Day"


@register("e02_volume_delta_frame_order", "signalid,timeperiod,eventparam,CallPhase,vol,delta_vol:i",
          "SELECT *, vol - lag(vol) OVER (ORDER BY timeperiod, signalid, eventparam) AS delta_vol FROM counts", "counts")
def e02(t):
    return ops.frame_delta(tv.counts(t))


@register("e03_flatline_counter", "signalid,timeperiod,eventparam,CallPhase,vol,delta_vol:i,flatlined:i",
          FLAT.format(src="counts").strip() + "\n---\nSELECT * FROM f", "counts")
def e03(t):
    return ops.with_flatline(tv.counts(t))


@register("e04_three_way_quality_filter", FLAG_COLUMNS,
          FLAT.format(src="counts").strip() + "\n---\n" + FLAGS.format(flat=3, top=60, jump=40), "counts")
def e04(t):
    return ops.filtered_counts(tv.counts(t), "15 min", thresholds=tv.THRESHOLDS)


@register("e04_quality_filter_default_thresholds", FLAG_COLUMNS,
          FLAT.format(src="counts").strip() + "\n---\n" + FLAGS.format(flat=20, top=300, jump=50), "counts")
def e04b(t):
    return ops.filtered_counts(tv.counts(t), "15 min")


ADJUSTED = """
    WITH d AS (SELECT signalid, CallPhase, eventparam, coalesce(sum(vol), 0) AS det FROM counts_with_gaps
               WHERE CallPhase IS NOT NULL GROUP BY ALL),
    p AS (SELECT signalid, CallPhase, sum(det) AS ph FROM d GROUP BY ALL),
    m AS (SELECT signalid, CallPhase, timeperiod, avg(vol) AS mvol FROM counts_with_gaps WHERE CallPhase IS NOT NULL GROUP BY ALL),
    a AS (SELECT c.signalid, c.timeperiod, c.eventparam, c.CallPhase, c.vol AS v, {share} AS Ph_Contr, mvol
          FROM counts_with_gaps c LEFT JOIN d USING (signalid, CallPhase, eventparam)
          LEFT JOIN p USING (signalid, CallPhase) LEFT JOIN m USING (signalid, CallPhase, timeperiod))
---
SELECT signalid, timeperiod, eventparam, CallPhase, coalesce(v, mvol * Ph_Contr) AS vol, Ph_Contr, mvol FROM a"""
ADJUSTED_COLUMNS = "signalid,timeperiod,eventparam,CallPhase,vol:r,Ph_Contr:r,mvol:r"


@register("e05_adjusted_counts_as_coded", ADJUSTED_COLUMNS,
          ADJUSTED.format(share="CAST(c.vol AS DOUBLE) / nullif(det, 0)"), "counts_with_gaps")
def e05(t):
    return ops.adjusted_counts(tv.counts_with_gaps(t))


@register("e05_adjusted_counts_by_share", ADJUSTED_COLUMNS,
          ADJUSTED.format(share="CAST(det AS DOUBLE) / nullif(ph, 0)"), "counts_with_gaps")
def e05b(t):
    return ops.adjusted_counts(tv.counts_with_gaps(t), "share")


@register("e13_group_totals_on_rows", "signalid,timeperiod,eventparam,vol,slot_vol:i",
          """SELECT signalid, timeperiod, eventparam, vol, sum(vol) OVER (PARTITION BY signalid, timeperiod) AS slot_vol
             FROM counts""", "counts")
def e13(t):
    rows = tv.counts(t).select("signalid", "timeperiod", "eventparam", "vol")
    totals = rows.groupBy("signalid", "timeperiod").agg(F.sum("vol").alias("slot_vol"))
    return scale.checked_join(rows, totals, ["signalid", "timeperiod"])


@register("b04_mainline_phases", "SignalID,Detector,Timeperiod,CallPhase,vol,Date:d",
          "SELECT * FROM report_counts WHERE CallPhase IN (2, 6)", "report_counts")
def b04(t):
    return filters.mainline(tv.report_counts(t))


@register("b05_normalised_names", "SignalID,Detector,Timeperiod,CallPhase,vol,Date:d", "SELECT * FROM report_counts", "report_counts")
def b05(t):
    raw = tv.counts(t).withColumnRenamed("timeperiod", "started")
    named = filters.report_names(filters.with_timeperiod(raw))
    return named.withColumn("Date", F.to_date("Timeperiod"))


@register("b12_rows_with_complete_keys", "SignalID,Detector,Timeperiod,CallPhase,vol,Date:d",
          "SELECT * FROM report_counts WHERE CallPhase IS NOT NULL", "report_counts")
def b12(t):
    return tv.report_counts(t).dropna(subset=["CallPhase"])


@register("d11_vehicles_per_hour", "SignalID,Week,DOW,Hour,vph:i",
          """SELECT SignalID, weekofyear(Hour) AS Week, isodow(Hour) AS DOW, Hour, sum(vol) AS vph
             FROM (SELECT SignalID, date_trunc('hour', Timeperiod) AS Hour, vol FROM report_counts WHERE CallPhase IN (2, 6))
             GROUP BY ALL""", "report_counts")
def d11(t):
    from corridor_metrics.functions.columns import floor_minutes

    return ops.vehicles_per_period(tv.report_counts(t).withColumn("Timeperiod", floor_minutes("Timeperiod", 60)))


@register("d11_vehicles_per_15min", "SignalID,Week,DOW,Timeperiod,vph:i",
          """SELECT SignalID, weekofyear(Timeperiod) AS Week, isodow(Timeperiod) AS DOW, Timeperiod, sum(vol) AS vph
             FROM report_counts GROUP BY ALL""", "report_counts")
def d11b(t):
    return ops.vehicles_per_period(tv.report_counts(t), "15 min", mainline_only=False)


@register("d12_vehicles_per_day", "SignalID,CallPhase,Date:d,vpd:i",
          "SELECT SignalID, CallPhase, Date, sum(vol) AS vpd FROM report_counts WHERE CallPhase IN (2, 6) GROUP BY ALL", "report_counts")
def d12(t):
    return ops.vehicles_per_day(tv.report_counts(t))


@register("d13_throughput", "SignalID,Date:d,vph:r",
          """WITH s AS (SELECT SignalID, Date, sum(vol) OVER (PARTITION BY SignalID, Date, Timeperiod) AS v FROM report_counts)
---
SELECT SignalID, Date, 4 * quantile_cont(CAST(v AS DOUBLE), 0.95) AS vph FROM s GROUP BY ALL""", "report_counts")
def d13(t):
    return ops.throughput(tv.report_counts(t))


@register("d13_throughput_by_period", "SignalID,Date:d,vph:r",
          """WITH s AS (SELECT SignalID, Date, Timeperiod, sum(vol) AS v FROM report_counts GROUP BY ALL)
---
SELECT SignalID, Date, 4 * quantile_cont(CAST(v AS DOUBLE), 0.95) AS vph FROM s GROUP BY ALL""", "report_counts")
def d13b(t):
    return ops.throughput(tv.report_counts(t), dedupe=True)


def flagged(t):
    return filters.report_names(ops.filtered_counts(tv.counts(t), "15 min", thresholds=tv.THRESHOLDS)).withColumn(
        "Date", F.to_date("Timeperiod")
    )


UPTIME = FLAT.format(src="counts").strip() + ", g AS (" + FLAGS.format(flat=3, top=60, jump=40) + """),
    d AS (SELECT DISTINCT signalid AS SignalID, eventparam AS Detector, CAST(timeperiod AS DATE) AS Date, CAST(Good_Day AS INTEGER) AS Good_Day FROM g),
    k AS (SELECT DISTINCT SignalID, Detector FROM d),
    c AS (SELECT CAST(unnest(generate_series(min(Date), max(Date), INTERVAL 1 DAY)) AS DATE) AS Date FROM d),
    u AS (SELECT k.SignalID, k.Detector, c.Date, coalesce(d.Good_Day, 0) AS Good_Day
          FROM k CROSS JOIN c LEFT JOIN d ON d.SignalID = k.SignalID AND d.Detector = k.Detector AND d.Date = c.Date)
---
SELECT * FROM u"""


@register("d21_detector_uptime_calendar", "SignalID,Detector,Date:d,Good_Day", UPTIME, "counts")
def d21(t):
    return ops.detector_uptime(flagged(t))


@register("d22_bad_detectors", "SignalID,Detector,Date:d,Good_Day", UPTIME + " WHERE Good_Day = 0", "counts")
def d22(t):
    return ops.bad_detectors(flagged(t))


HOURS = """SELECT h.*, d.CallPhase FROM (SELECT date_trunc('hour', "timestamp") AS timeperiod, signalid % 5 AS signalid, eventparam,
    count(*) AS vol FROM event_log WHERE eventcode = {code} GROUP BY ALL) h LEFT JOIN det_config d
    ON h.signalid = d.signalid AND h.eventparam = d.eventparam"""
MERGED = ("WITH rc AS (" + HOURS.format(code=82) + "), v AS (" + HOURS.format(code=81) + "), p AS (" + HOURS.format(code=1) + "), "
          + FLAT.format(src="v").strip()[5:] + ", g AS (" + FLAGS.format(flat=5, top=1200, jump=200)) + """),
    fc AS (SELECT signalid, timeperiod, eventparam, CallPhase, Good_Day FROM g),
    ac AS (SELECT signalid, timeperiod, eventparam, CallPhase, CAST(vol AS DOUBLE) AS vol FROM p),
    m AS (SELECT coalesce(rc.signalid, fc.signalid) AS signalid, coalesce(rc.timeperiod, fc.timeperiod) AS timeperiod,
                 coalesce(rc.eventparam, fc.eventparam) AS eventparam, coalesce(rc.CallPhase, fc.CallPhase) AS CallPhase,
                 rc.vol AS vol_rc, fc.Good_Day
          FROM rc FULL OUTER JOIN fc ON rc.signalid = fc.signalid AND rc.timeperiod = fc.timeperiod
               AND rc.eventparam = fc.eventparam AND coalesce(rc.CallPhase, -1) = coalesce(fc.CallPhase, -1)),
    j AS (SELECT coalesce(m.signalid, ac.signalid) AS SignalID, CAST(coalesce(m.timeperiod, ac.timeperiod) AS DATE) AS Date,
                 coalesce(m.timeperiod, ac.timeperiod) AS Timeperiod, coalesce(m.eventparam, ac.eventparam) AS Detector,
                 coalesce(m.CallPhase, ac.CallPhase) AS CallPhase, vol_rc, Good_Day, ac.vol AS vol_ac
          FROM m FULL OUTER JOIN ac ON m.signalid = ac.signalid AND m.timeperiod = ac.timeperiod
               AND m.eventparam = ac.eventparam AND coalesce(m.CallPhase, -1) = coalesce(ac.CallPhase, -1)),
    days AS (SELECT CAST(timeperiod AS DATE) AS Date FROM rc INTERSECT SELECT CAST(timeperiod AS DATE) FROM fc
             INTERSECT SELECT CAST(timeperiod AS DATE) FROM ac)"""


def three(t):
    """Raw, filtered and adjusted hourly counts: of three event codes, so that their keys differ."""
    dense = tv.event_log(t).withColumn("signalid", F.col("signalid") % 5)
    raw, checked, adjusted = (ops.detector_counts(dense, tv.det_config(t), "hours", code) for code in (82, 81, 1))
    checked = ops.filtered_counts(checked, thresholds=tv.THRESHOLDS)
    return [
        filters.report_names(df).withColumn("Date", F.to_date("Timeperiod")) for df in (raw, checked, adjusted)
    ]


@register("c03_full_outer_three_counts", "SignalID,Date:d,Timeperiod,Detector,CallPhase,vol_rc,Good_Day,vol_ac:r",
          MERGED + "\n---\nSELECT * FROM j", "event_log det_config")
def c03(t):
    return signal_detail.merged_counts(*three(t))


@register("s20_masked_volumes", "SignalID,Date:d,Timeperiod,Detector,CallPhase,vol_rc,Good_Day,vol_ac:i,bad_day,Hour",
          MERGED + """
---
SELECT SignalID, Date, Timeperiod, Detector, CallPhase, vol_rc, Good_Day, coalesce(Good_Day = false, false) AS bad_day,
       CASE WHEN Good_Day = false THEN vol_ac END AS vol_ac, hour(Timeperiod) AS Hour FROM j""", "event_log det_config")
def s20(t):
    return signal_detail.masked(signal_detail.merged_counts(*three(t)))


@register("g01_signal_detail", "SignalID,date:d,records,first_detector,first_hour,bad:i,vol_rc:i,vol_ac:i",
          MERGED + """
---
SELECT SignalID, Date AS date, count(*) AS records, min(Detector) AS first_detector,
       arg_min(hour(Timeperiod), Detector * 100 + hour(Timeperiod)) AS first_hour,
       count(*) FILTER (WHERE Good_Day = false) AS bad, sum(vol_rc) AS vol_rc,
       sum(CASE WHEN Good_Day = false THEN vol_ac END) AS vol_ac
FROM j WHERE Date IN (SELECT Date FROM days) GROUP BY ALL""", "event_log det_config")
def g01(t):
    nested, first = signal_detail.signal_details(*three(t)), F.element_at("data", 1)

    def sum_of(field: str):
        """Sum of a record field; NULL when no record has it."""
        values = F.array_compact(F.transform("data", lambda r: r[field]))
        return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v))

    return nested.select(
        "SignalID", "date", F.size("data").cast("long").alias("records"), first["Detector"].alias("first_detector"),
        first["Hour"].alias("first_hour"), F.size(F.filter("data", lambda r: r["bad_day"])).cast("long").alias("bad"),
        sum_of("vol_rc").alias("vol_rc"), sum_of("vol_ac").alias("vol_ac"),
    )


@register("s19_nest_and_unnest", "SignalID,Date:d,Detector,CallPhase,vol_rc,Good_Day,vol_ac:i,bad_day,Hour",
          MERGED + """
---
SELECT SignalID, Date, Detector, CallPhase, vol_rc, Good_Day, coalesce(Good_Day = false, false) AS bad_day,
       CASE WHEN Good_Day = false THEN vol_ac END AS vol_ac, hour(Timeperiod) AS Hour FROM j""", "event_log det_config")
def s19(t):
    nested = signal_detail.nest(signal_detail.masked(signal_detail.merged_counts(*three(t))))
    return signal_detail.unnest(nested)


@register("g14_counts_job_filtered", FLAG_COLUMNS,
          """WITH h AS (SELECT date_trunc('hour', "timestamp") AS timeperiod, signalid, eventparam, count(*) AS vol
                FROM event_log WHERE eventcode = 82 GROUP BY ALL),
             x AS (SELECT h.signalid, timeperiod, h.eventparam, CallPhase, vol FROM h LEFT JOIN det_config USING (signalid, eventparam)), """
          + FLAT.format(src="x").strip()[5:] + "\n---\n" + FLAGS.format(flat=5, top=1200, jump=200), "event_log det_config")
def g14(t):
    return counts_jobs.counts_outputs(signal_activity(tv.event_log(t)), tv.det_config(t), RUN)["filtered_counts_1hr"]


@register("g15_month_job_volumes", "SignalID,CallPhase,Date:d,vpd:r",
          """SELECT SignalID, CallPhase, Date, sum(vol) AS vpd FROM report_counts WHERE CallPhase IN (2, 6)
             AND Date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY ALL""", "report_counts")
def g15(t):
    counts = tv.counts(t)
    filtered = ops.filtered_counts(counts, "15 min", thresholds=tv.THRESHOLDS)
    return counts_jobs.month_outputs(filtered, filtered, dt.date(2024, 1, 1), RUN)["vehicles_pd"]


@register("g15_month_job_throughput", "SignalID,Date:d,vph:r",
          """WITH s AS (SELECT SignalID, Date, sum(vol) OVER (PARTITION BY SignalID, Date, Timeperiod) AS v FROM report_counts)
---
SELECT SignalID, Date, 4 * quantile_cont(CAST(v AS DOUBLE), 0.95) AS vph FROM s GROUP BY ALL""", "report_counts")
def g15b(t):
    counts = tv.counts(t)
    filtered = ops.filtered_counts(counts, "15 min", thresholds=tv.THRESHOLDS)
    return counts_jobs.month_outputs(filtered, filtered, dt.date(2024, 1, 1), RUN)["throughput"]


MONTH_ADJUSTED = ADJUSTED.replace(
    "\nSELECT signalid, timeperiod", """
, x AS (SELECT signalid, timeperiod""").replace("Ph_Contr, mvol FROM a", "Ph_Contr, mvol FROM a)").replace("---\n", "").format(share="CAST(det AS DOUBLE) / nullif(ph, 0)") + """
---
SELECT o.output, signalid AS SignalID, CallPhase, eventparam AS Detector, timeperiod AS Timeperiod, CAST(timeperiod AS DATE) AS Date, vol
FROM x, (VALUES ('adjusted_counts_1hr'), ('adjusted_counts_15min')) o(output)"""


@register("g15_month_job_adjusted_counts", "output,SignalID,CallPhase,Detector,Timeperiod,Date:d,vol:r", MONTH_ADJUSTED, "counts_with_gaps")
def g15c(t):
    counts = tv.counts_with_gaps(t)
    outputs = counts_jobs.month_outputs(counts, counts, dt.date(2024, 1, 1), RUN, "share")
    hour, quarter = (outputs[k].withColumn("output", F.lit(k)) for k in ("adjusted_counts_1hr", "adjusted_counts_15min"))
    return hour.unionByName(quarter)


@register("g15_month_job_vehicles_15min", "SignalID,Week,DOW,Timeperiod,vph:r",
          """SELECT SignalID, weekofyear(Timeperiod) AS Week, isodow(Timeperiod) AS DOW, Timeperiod, sum(vol) AS vph
             FROM report_counts WHERE CallPhase IN (2, 6) GROUP BY ALL""", "report_counts")
def g15d(t):
    counts = tv.counts(t)
    return counts_jobs.month_outputs(counts, counts, dt.date(2024, 1, 1), RUN)["vehicles_15min"]


@register("g15_month_job_details_written", "SignalID,date:d,records,first_detector,first_hour,bad,vol_rc:i",
          "WITH h AS (" + HOURS.format(code=82) + "), " + FLAT.format(src="h").strip()[5:] + ", g AS (" + FLAGS.format(flat=5, top=1200, jump=200) + """),
          j AS (SELECT signalid AS SignalID, timeperiod AS Timeperiod, eventparam AS Detector, vol, Good_Day FROM g)
---
SELECT SignalID, CAST(Timeperiod AS DATE) AS date, count(*) AS records, min(Detector) AS first_detector,
       arg_min(hour(Timeperiod), Detector * 100 + hour(Timeperiod)) AS first_hour,
       count(*) FILTER (WHERE NOT Good_Day) AS bad, sum(vol) AS vol_rc FROM j GROUP BY ALL""", "event_log det_config")
def g15e(t):
    from dataclasses import replace

    from corridor_metrics.context import scratch_path

    ctx = replace(RUN, root=scratch_path(t.spark, "month"))
    dense = tv.event_log(t).withColumn("signalid", F.col("signalid") % 5)
    counts = ops.detector_counts(dense, tv.det_config(t), "hours")
    filtered = ops.filtered_counts(counts, "1 hour", thresholds=tv.THRESHOLDS)
    counts_jobs.run_month(counts, filtered, filtered, dt.date(2024, 1, 1), ctx)
    details, first = t.spark.read.parquet(f"{ctx.root}/signal_details"), F.element_at("data", 1)
    return details.select(
        F.col("SignalID").cast("long").alias("SignalID"), "date", F.size("data").cast("long").alias("records"), first["Detector"].alias("first_detector"),
        first["Hour"].alias("first_hour"), F.size(F.filter("data", lambda r: r["bad_day"])).cast("long").alias("bad"),
        F.aggregate("data", F.lit(0).cast("long"), lambda a, r: a + F.coalesce(r["vol_rc"], F.lit(0))).alias("vol_rc"),
    )


@register("g16_adjusted_count_staging", ADJUSTED_COLUMNS,
          ADJUSTED.replace("counts_with_gaps", "staged").replace("WITH d AS", """WITH staged AS (SELECT * FROM counts_with_gaps
              WHERE CAST(timeperiod AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'), d AS""")
          .format(share="CAST(det AS DOUBLE) / nullif(ph, 0)"), "counts_with_gaps")
def g16(t):
    return counts_jobs.stage_adjusted(tv.counts_with_gaps(t), START, END, "share")


@register("g22_signal_batches", "SignalID,records,batch",
          """WITH s AS (SELECT SignalID, count(*) AS records FROM report_counts GROUP BY ALL),
             n AS (SELECT *, row_number() OVER (ORDER BY SignalID) AS rn, sum(records) OVER () AS total, count(*) OVER () AS sigs FROM s)
---
SELECT SignalID, records,
       CAST(floor((rn - 1) / greatest(1, round_even(10000 / (total / sigs), 0))) AS BIGINT) AS batch FROM n""", "report_counts")
def g22(t):
    return ops.signal_batches(tv.report_counts(t), 10_000)


PED_DELAY = """WITH s AS (SELECT * FROM event_log WHERE eventcode = 90), e AS (SELECT * FROM event_log WHERE eventcode = 0),
             w AS (SELECT s.signalid, s."timestamp" AS b, min(e."timestamp") AS f
                   FROM s JOIN e ON s.signalid = e.signalid AND s.eventparam = e.eventparam AND e."timestamp" >= s."timestamp"
                   GROUP BY s.signalid, s.eventparam, s."timestamp")
---
SELECT signalid AS SignalID, CAST(b AS DATE) AS Date, CAST(sum(epoch_us(f) - epoch_us(b)) AS DOUBLE) / (count(*) * 1e6) AS ped_delay FROM w GROUP BY ALL"""
SPLIT_FAILURES = """WITH g AS (SELECT c.signalid, c.CallPhase, c."timestamp" AS s, min(r."timestamp") AS e FROM cycle_events c
                JOIN cycle_events r ON r.signalid = c.signalid AND r.CallPhase = c.CallPhase AND r."timestamp" >= c."timestamp"
                WHERE c.eventcode = 1 AND r.eventcode = 0 GROUP BY ALL),
             g2 AS (SELECT * FROM g WHERE e > s),
             d AS (SELECT a.signalid, a.eventparam, a."timestamp" AS s, min(b."timestamp") AS e FROM event_log a
                JOIN event_log b ON a.signalid = b.signalid AND a.eventparam = b.eventparam AND b."timestamp" >= a."timestamp"
                WHERE a.eventcode = 82 AND b.eventcode = 81 GROUP BY ALL),
             d2 AS (SELECT signalid, eventparam, e, min(s) AS s FROM d GROUP BY ALL),
             o AS (SELECT d2.signalid, k.CallPhase, d2.s, d2.e FROM d2 JOIN det_config k USING (signalid, eventparam) WHERE k.CallPhase IS NOT NULL),
             l AS (SELECT signalid, CallPhase, count(DISTINCT eventparam) AS lanes FROM det_config WHERE CallPhase IS NOT NULL GROUP BY ALL),
             w AS (SELECT g2.signalid, g2.CallPhase, g2.s AS green, 'g' AS part, g2.s AS ws, g2.e AS we FROM g2
                   UNION ALL SELECT g2.signalid, g2.CallPhase, g2.s, 'r', g2.e, g2.e + INTERVAL 5 SECOND FROM g2),
             b AS (SELECT w.signalid, w.CallPhase, w.green, w.part, w.ws, w.we, any_value(lanes) AS lanes,
                          coalesce(sum(CASE WHEN o.s IS NOT NULL THEN epoch_us(least(w.we, o.e)) - epoch_us(greatest(w.ws, o.s)) END), 0) AS busy
                   FROM w JOIN l ON l.signalid = w.signalid AND l.CallPhase = w.CallPhase
                   LEFT JOIN o ON o.signalid = w.signalid AND o.CallPhase = w.CallPhase AND o.s < w.we AND o.e > w.ws
                   GROUP BY ALL),
             c AS (SELECT signalid, CallPhase, green,
                          max(CASE WHEN part = 'g' THEN busy / ((epoch_us(we) - epoch_us(ws)) * lanes) END) AS og,
                          max(CASE WHEN part = 'r' THEN busy / ((epoch_us(we) - epoch_us(ws)) * lanes) END) AS orr FROM b GROUP BY ALL)
---
SELECT signalid AS SignalID, CallPhase, time_bucket(INTERVAL {minutes} MINUTE, green) AS Timeperiod, count(*) AS cycles,
       count(*) FILTER (WHERE og >= 0.3 AND orr >= 0.3) AS split_failures FROM c GROUP BY ALL"""


@register("i01_next_event_delay", "SignalID,Date:d,ped_delay:r",
          PED_DELAY,
          "event_log")
def i01(t):
    return delays.ped_delay(tv.event_log(t), start_code=90, end_code=0)


@register("i02_split_failures", "SignalID,CallPhase,Timeperiod,cycles,split_failures",
          SPLIT_FAILURES.format(minutes=60),
          "event_log cycle_events det_config")
def i02(t):
    return delays.split_failures(
        tv.cycle_events(t), tv.event_log(t), tv.det_config(t), 60, red_code=0, share=0.3, slot_minutes=60,
    )


@register("g17_ped_delay_output", "SignalID,Date:d,ped_delay:r", PED_DELAY, "event_log")
def g17b(t):
    return counts_jobs.ped_delays(tv.event_log(t), start_code=90, end_code=0)["ped_delay"]


@register("g17_split_failures_15min_output", "SignalID,CallPhase,Timeperiod,cycles,split_failures", SPLIT_FAILURES.format(minutes=15),
          "event_log cycle_events det_config")
def g17c(t):
    outputs = counts_jobs.split_failure_outputs(tv.cycle_events(t), tv.event_log(t), tv.det_config(t), red_code=0, share=0.3)
    return outputs["split_failures_15min"]
