"""Mart reads, report slices and latest-entry queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.context import scratch_path
from corridor_metrics.operators import marts as ops
from corridor_metrics.operators.filters import zone_group_predicate
from corridor_metrics.plans import signal_detail
from corridor_metrics.registry import register
from corridor_metrics.registry.counts import MERGED, three
from corridor_metrics.registry.rollups import DELTA
from corridor_metrics.sources.sinks import save_mart

MONTH = dt.date(1997, 5, 1)
METRIC = {"table": "vpd", "hourly_table": "vph"}


def mart(t):
    from corridor_metrics.operators.rollups import with_delta

    return with_delta(tv.mart(t), ["Zone_Group", "Zone", "Corridor"], "Month", "tp")


MART = "WITH m AS (SELECT *, " + DELTA.format(v="tp", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Month") + " FROM mart)\n---\n"
MART_COLUMNS = "Zone_Group,Zone,Corridor,Month:d,tp:r,ones,delta:r"


def stored(t, level, period, metric, df):
    root = scratch_path(t.spark, "marts")
    save_mart(df, root, level, period, metric)
    return root


@register("g03_mart_read_up_to_month", MART_COLUMNS,
          MART + "SELECT * FROM m WHERE Zone_Group = 'RTOP1' AND Month <= DATE '1997-05-01'", "mart")
def g03(t):
    root = stored(t, "cor", "mo", "vpd", mart(t))
    return ops.query_mart(t.spark, root, METRIC, zone_group="RTOP1", month=MONTH)


@register("g03_mart_read_one_corridor_month", MART_COLUMNS,
          MART + "SELECT * FROM m WHERE Zone_Group = 'RTOP2' AND Corridor = 'NATION_6' AND Month = DATE '1997-05-01'", "mart")
def g03b(t):
    root = stored(t, "cor", "mo", "vpd", mart(t))
    return ops.query_mart(t.spark, root, METRIC, zone_group="RTOP2", corridor="NATION_6", month=MONTH, upto=False)


@register("g03_mart_read_hourly", "SignalID,Hour,vph:r",
          "SELECT * FROM hourly_metric WHERE Hour >= TIMESTAMP '2024-01-01' AND Hour <= TIMESTAMP '2024-01-31 23:00:00'", "hourly_metric")
def g03c(t):
    root = stored(t, "sig", "mo", "vph", tv.hourly_metric(t))
    return ops.query_mart(
        t.spark, root, METRIC, "signal", hourly=True, zone_group="All", month=dt.date(2024, 1, 1), upto=False
    )


def daily_mart(t):
    rows = t.orders.join(tv.corridors(t), F.col("o_custkey") == F.col("SignalID")).where(F.col("Corridor").isNotNull())
    return rows.groupBy("Zone_Group", "Corridor", F.to_date("o_orderdate").alias("Date")).agg(
        F.sum(F.floor("o_totalprice")).cast("double").alias("tp")
    )


DAILY = """SELECT Zone_Group, Corridor, CAST(o_orderdate AS DATE) AS Date, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS tp
    FROM orders JOIN corridors ON o_custkey = SignalID WHERE Corridor IS NOT NULL GROUP BY ALL"""


@register("g03_mart_read_daily", "Zone_Group,Corridor,Date:d,tp:r",
          f"WITH d AS ({DAILY})\n---\nSELECT * FROM d WHERE Zone_Group = 'RTOP1' AND Date <= DATE '1997-05-31'", "corridors")
def g03d(t):
    root = stored(t, "cor", "dy", "vpd", daily_mart(t))
    return ops.query_mart(t.spark, root, METRIC, resolution="daily", zone_group="RTOP1", month=MONTH)


@register("g03_mart_read_quarterly", "Zone_Group,Corridor,Quarter:r,tp:r",
          f"""WITH d AS ({DAILY}), q4 AS (SELECT Zone_Group, Corridor, year(Date) + quarter(Date) / 10 AS Quarter, sum(tp) AS tp FROM d GROUP BY ALL)
---
SELECT * FROM q4 WHERE Zone_Group = 'RTOP1' AND Quarter = 1997.2""", "corridors")
def g03e(t):
    quarter = (F.year("Date") + F.quarter("Date") / 10).alias("Quarter")
    df = daily_mart(t).groupBy("Zone_Group", "Corridor", quarter).agg(F.sum("tp").alias("tp"))
    root = stored(t, "cor", "qu", "vpd", df)
    return ops.query_mart(
        t.spark, root, METRIC, resolution="quarterly", zone_group="RTOP1", quarter=1997.2, upto=False
    )


def zoned_mart(t):
    """A mart filed by zone names."""
    return mart(t).select(F.col("Zone").alias("Zone_Group"), "Corridor", "Month", "tp")


ZONED = "WITH m AS (SELECT Zone AS Zone_Group, Corridor, Month, tp FROM mart)\n---\nSELECT * FROM m WHERE Month = DATE '1997-05-01' AND "


@register("g04_health_read_zone_group", "Zone_Group,Corridor,Month:d,tp:r",
          ZONED + "Zone_Group IN ('All RTOP', 'RTOP1', 'Zone 1', 'Zone 2', 'Zone 3', 'Zone 8')", "mart")
def g04(t):
    root = stored(t, "sub", "mo", "maint", zoned_mart(t))
    return ops.query_health(t.spark, root, "maint", "corridor", "RTOP1", None, MONTH)


@register("g04_health_read_one_corridor", "Zone_Group,Corridor,Month:d,tp:r", ZONED + "Corridor = 'NATION_3'", "mart")
def g04b(t):
    root = stored(t, "sig", "mo", "ops", zoned_mart(t))
    return ops.query_health(t.spark, root, "ops", "signal", "Zone 4", "NATION_3", MONTH)


@register("b10_zone_set_expansion", "Zone_Group,Corridor,Month:d,tp:r",
          "WITH m AS (SELECT Zone AS Zone_Group, Corridor, Month, tp FROM mart)\n---\nSELECT * FROM m WHERE Zone_Group IN ('Zone 7m', 'Zone 7d')", "mart")
def b10(t):
    return zoned_mart(t).where(zone_group_predicate("corridor", "Zone 7", None))


@register("g05_user_delay_read", "Zone,Month:d,month_hour,udc:r",
          """SELECT o_orderpriority AS Zone, CAST(date_trunc('month', o_orderdate) AS DATE) AS Month, o_orderdate AS month_hour,
             floor(o_totalprice) AS udc FROM orders WHERE o_orderpriority = '2-HIGH' AND date_trunc('month', o_orderdate) <= DATE '1997-05-01'""")
def g05(t):
    df = t.orders.select(
        F.col("o_orderpriority").alias("Zone"), F.to_date(F.trunc(F.to_date("o_orderdate"), "month")).alias("Month"),
        F.col("o_orderdate").alias("month_hour"), F.floor("o_totalprice").cast("double").alias("udc"),
    )
    root = stored(t, "cor", "mo", "hourly_udc", df)
    return ops.query_user_delay(t.spark, root, "2-HIGH", MONTH)


@register("g06_value_box", "Corridor,val,del",
          MART + """SELECT Corridor, format('{:,}', CAST(tp AS BIGINT)) AS val,
             CASE WHEN coalesce(delta, 0) > 0 THEN ' (+' ELSE ' (' END || printf('%.1f%%', coalesce(delta, 0) * 100) || ')' AS del
             FROM m WHERE Corridor = 'NATION_7' AND Month = DATE '1997-05-01'""", "mart")
def g06(t):
    return ops.value_box(mart(t), "tp", "integer", "NATION_7", MONTH)


@register("g07_dashboard_month_bars", "Corridor,var:r,col",
          """SELECT Corridor, tp AS var, CASE WHEN Corridor = 'RTOP1' THEN 'red' ELSE 'lightgray' END AS col FROM mart
             WHERE Zone_Group = 'RTOP1' AND Month = DATE '1997-05-01'""", "mart")
def g07(t):
    return ops.dashboard_slices(daily_mart(t), mart(t), "tp", MONTH, "RTOP1", "red")["month"]


@register("g07_dashboard_weekly_trend", "Corridor,Date:d,var:r,col",
          f"""WITH d AS ({DAILY})
---
SELECT Corridor, Date, tp AS var, 1 AS col FROM d WHERE Zone_Group = 'RTOP1' AND Date < DATE '1997-05-31'""", "corridors")
def g07b(t):
    return ops.dashboard_slices(daily_mart(t), mart(t), "tp", MONTH, "RTOP1", "red")["week"]


@register("g07_dashboard_hours_of_month", "Corridor,Hour,var:r,col",
          """SELECT Corridor, Hour, vph AS var, 1 AS col FROM hourly_metric JOIN corridors USING (SignalID)
             WHERE Zone_Group = 'RTOP1' AND Corridor IS NOT NULL""", "hourly_metric corridors")
def g07c(t):
    from corridor_metrics.operators.rollups import in_corridors

    hourly = in_corridors(tv.hourly_metric(t), tv.corridors(t), ["Zone_Group", "Corridor"]).withColumnRenamed("vph", "tp")
    return ops.dashboard_slices(daily_mart(t), mart(t), "tp", dt.date(2024, 1, 1), "RTOP1", "red", hourly)["hour"]


# Metric, name, goal text, goal value, sign.
GOAL_VALUES = """
    ('du', 'Vehicle Detector Availability', '> 95%', 0.95, '>'),
    ('pau', 'Ped Pushbutton Availability', '> 95%', 0.95, '>'),
    ('cctvu', 'CCTV Availability', '> 95%', 0.95, '>'),
    ('cu', 'Communications Uptime', '> 95%', 0.95, '>'),
    ('tp', 'Traffic Volume (Throughput)', '< 5% dec. from prev. mo', -0.05, '>'),
    ('aog', 'Arrivals on Green', '> 80%', 0.8, '>'),
    ('qs', 'Queue Spillback Rate', '< 10%', 0.1, '<'),
    ('sf', 'Split Failure', '< 5%', 0.05, '<'),
    ('tti', 'Travel Time Index', '< 2.0', 2.0, '<'),
    ('pti', 'Planning Time Index', '< 2.0', 2.0, '<'),
    ('tasks', 'Outstanding Tasks', 'Dec. from prev. mo', 0.0, '<')"""


@register("g08_goals_met", "metric,Corridor,Month:d,delta:r,name,goal,goal_value:r,sign,goal_met",
          "WITH g(metric, name, goal, goal_value, sign) AS (VALUES " + GOAL_VALUES + "), "
          + MART[5:].replace("\n---\n", ", x AS (SELECT CASE WHEN ones % 2 = 0 THEN 'tp' ELSE 'tasks' END AS metric, Corridor, Month, delta FROM m)\n---\n")
          + """SELECT x.*, name, goal, goal_value, sign, CASE sign WHEN '>' THEN delta > goal_value ELSE delta < goal_value END AS goal_met
             FROM x LEFT JOIN g ON x.metric = g.metric""", "mart")
def g08(t):
    rows = mart(t).select(F.when(F.col("ones") % 2 == 0, "tp").otherwise("tasks").alias("metric"), "Corridor", "Month", "delta")
    return ops.with_goals(rows, "delta")


@register("g02_signal_data_read", "SignalID,date:d,hour,Detector,CallPhase,vol_rc,vol_ac:i,bad_day,Timeperiod",
          MERGED + """
---
SELECT SignalID, Date AS date, hour(Timeperiod) AS hour, Detector, coalesce(CallPhase, 0) AS CallPhase, vol_rc,
       CASE WHEN Good_Day = false THEN vol_ac END AS vol_ac, coalesce(Good_Day = false, false) AS bad_day,
       date_trunc('hour', Timeperiod) AS Timeperiod
FROM j WHERE SignalID = 3 AND Date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AND Date IN (SELECT Date FROM days)""", "event_log det_config")
def g02(t):
    details = signal_detail.signal_details(*three(t))
    return ops.read_signal_data(details, 3, dt.date(2024, 1, 3), dt.date(2024, 1, 20))


@register("e08_last_modified_with_ties", "Month:d,Zone,LastModified,entry",
          "SELECT * FROM progress QUALIFY rank() OVER (PARTITION BY Month, Zone ORDER BY LastModified DESC) = 1", "progress")
def e08(t):
    return ops.last_modified(tv.progress(t))


@register("e09_ten_latest_entries", "Month:d,Zone,LastModified,entry",
          "SELECT * FROM progress QUALIFY row_number() OVER (PARTITION BY Month, Zone ORDER BY LastModified DESC, entry) <= 10", "progress")
def e09(t):
    return ops.latest_entries(tv.progress(t), F.asc("entry"))
