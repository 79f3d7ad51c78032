"""Roll-up queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.functions.columns import month_start, week_start
from corridor_metrics.operators import rollups as ops
from corridor_metrics.operators.filters import peak_hours
from corridor_metrics.registry import register

AM_PM = (7, 8, 16, 17)

SIGNAL_DAILY = """
    SELECT SignalID, {per} AS {name}, coalesce(sum(uptime * {w}), 0) / nullif(sum({w}), 0) AS uptime, sum({w}) AS {wn}
    FROM daily_metric GROUP BY ALL"""

BY_CORRIDOR = """
    SELECT Zone_Group, Zone, Corridor, CAST(date_trunc('month', Date) AS DATE) AS Month,
           sum(uptime * num) / sum(num) AS uptime, sum(num) AS num
    FROM daily_metric JOIN corridors USING (SignalID) WHERE Corridor IS NOT NULL GROUP BY ALL"""

DELTA = "({v} - lag({v}) OVER ({w})) / nullif(lag({v}) OVER ({w}), 0) AS delta"


def monthly(t):
    return tv.daily_metric(t).withColumn("Month", month_start("Date"))


def by_corridor(t, **kw):
    return ops.weighted_mean_by_corridor(monthly(t), "Month", tv.corridors(t), "uptime", "num", **kw)


@register("d01_weighted_mean_by_corridor", "Zone_Group,Zone,Corridor,Month:d,uptime:r,num:r,delta:r",
          f"WITH a AS ({BY_CORRIDOR})\n---\nSELECT *, "
          + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Month") + " FROM a",
          "daily_metric corridors")
def d01(t):
    return by_corridor(t)


@register("d01_mean_by_corridor_unweighted", "Zone_Group,Zone,Corridor,Month:d,uptime:r,delta:r",
          """WITH a AS (SELECT Zone_Group, Zone, Corridor, CAST(date_trunc('month', Date) AS DATE) AS Month, avg(uptime) AS uptime
             FROM daily_metric JOIN corridors USING (SignalID) WHERE Corridor IS NOT NULL GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Month") + " FROM a",
          "daily_metric corridors")
def d01b(t):
    return ops.weighted_mean_by_corridor(monthly(t), "Month", tv.corridors(t), "uptime")


@register("c01_join_corridors", "SignalID,Date:d,uptime:r,num:r,Zone_Group,Zone,Corridor",
          """SELECT m.*, Zone_Group, Zone, Corridor FROM daily_metric m LEFT JOIN corridors USING (SignalID)
             WHERE Corridor IS NOT NULL""", "daily_metric corridors")
def c01(t):
    return ops.in_corridors(tv.daily_metric(t), tv.corridors(t), ops.CORRIDOR_KEYS)


@register("d02_corridor_group", "Zone_Group,Corridor,Month:d,uptime:r,num:r,delta:r",
          f"""WITH a AS ({BY_CORRIDOR}), g AS (SELECT 'All RTOP' AS Zone_Group, 'All RTOP' AS Corridor, Month,
              sum(uptime * num) / sum(num) AS uptime, sum(num) AS num FROM a WHERE Zone_Group IN ('RTOP1', 'RTOP2') GROUP BY Month)
---
SELECT *, """ + DELTA.format(v="uptime", w="ORDER BY Month") + " FROM g", "daily_metric corridors")
def d02(t):
    rows = by_corridor(t).where(F.col("Zone_Group").isin("RTOP1", "RTOP2"))
    return ops.corridor_group(rows, "Month", "uptime", "num", "All RTOP")


GROUP_PARTS = [
    ("Zone", "true"), ("'All RTOP'", "Zone_Group IN ('RTOP1', 'RTOP2')"), ("'RTOP1'", "Zone_Group = 'RTOP1'"),
    ("'RTOP2'", "Zone_Group = 'RTOP2'"), ("'Zone 7'", "Zone IN ('Zone 7m', 'Zone 7d')"),
]


@register("d03_overlapping_zone_roll_up", "Zone_Group,Zone,Corridor,Month:d,uptime:r,num:r,delta:r",
          f"WITH a AS ({BY_CORRIDOR}), c AS (SELECT *, "
          + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Month") + " FROM a), g AS ("
          + " UNION ALL ".join(
              f"SELECT {label} AS grp, Month, sum(uptime * num) / sum(num) AS uptime, sum(num) AS num FROM a WHERE {cond} GROUP BY ALL"
              for label, cond in GROUP_PARTS)
          + ")\n---\nSELECT NULL AS Zone_Group, Zone, Corridor, Month, uptime, num, delta FROM c UNION "
            "SELECT grp, NULL, grp, Month, uptime, num, "
          + DELTA.format(v="uptime", w="PARTITION BY grp ORDER BY Month") + " FROM g", "daily_metric corridors")
def d03(t):
    out = ops.corridor_groups(by_corridor(t), "Month", "uptime", "num")
    return out.select("Zone_Group", "Zone", "Corridor", "Month", "uptime", "num", "delta")


@register("d04_period_avg_by_signal", "SignalID,Month:d,uptime:r,ones:r,delta:r",
          "WITH a AS (" + SIGNAL_DAILY.format(per="CAST(date_trunc('month', Date) AS DATE)", name="Month", w="1.0", wn="ones")
          + ")\n---\nSELECT *, " + DELTA.format(v="uptime", w="PARTITION BY SignalID ORDER BY Month") + " FROM a", "daily_metric")
def d04(t):
    return ops.period_avg(monthly(t), "uptime", "Month")


@register("d05_period_sum_by_signal", "SignalID,Month:d,num:r,delta:r",
          """WITH a AS (SELECT SignalID, CAST(date_trunc('month', Date) AS DATE) AS Month, sum(num) AS num FROM daily_metric GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="num", w="PARTITION BY SignalID ORDER BY Month") + " FROM a", "daily_metric")
def d05(t):
    return ops.period_sum(monthly(t), "num", "Month")


@register("d06_daily_avg_peak_hours", "SignalID,Date:d,v:r,ones:r,delta:r",
          """WITH a AS (SELECT SignalID, Date, sum(v) / count(*) AS v, count(*) AS ones FROM event_metric
             WHERE hour(Date_Hour) IN (7, 8, 16, 17) GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="v", w="PARTITION BY SignalID ORDER BY Date") + " FROM a", "event_metric")
def d06(t):
    return ops.daily_avg(tv.event_metric(t), "v", peak_only=True, hours=AM_PM)


@register("b06_peak_hours", "SignalID,Date_Hour,Date:d,v:r",
          "SELECT * FROM event_metric WHERE hour(Date_Hour) IN (7, 8, 16, 17)", "event_metric")
def b06(t):
    return peak_hours(tv.event_metric(t), AM_PM)


@register("d07_daily_avg_by_camera", "CameraID,Date:d,uptime:r,num:r,delta:r",
          """WITH m AS (SELECT 'CAM-' || SignalID AS CameraID, Date, uptime, num FROM daily_metric),
             a AS (SELECT CameraID, Date, sum(uptime * num) / sum(num) AS uptime, sum(num) AS num FROM m GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY CameraID ORDER BY Date") + " FROM a", "daily_metric")
def d07(t):
    return ops.daily_avg_camera(tv.daily_metric(t).withColumn("CameraID", F.concat(F.lit("CAM-"), F.col("SignalID"))))


@register("d23_detector_uptime_corridor_weekly", "Zone_Group,Zone,Corridor,Week:d,uptime:r,ones:r,delta:r",
          """WITH w AS (SELECT SignalID, CAST(date_trunc('week', Date) AS DATE) AS Week, avg(uptime) AS uptime
                FROM daily_metric GROUP BY ALL),
             a AS (SELECT Zone_Group, Zone, Corridor, Week, sum(uptime) / count(*) AS uptime, count(*) AS ones
                FROM w JOIN corridors USING (SignalID) WHERE Corridor IS NOT NULL GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Week") + " FROM a",
          "daily_metric corridors")
def d23(t):
    weekly = ops.signal_uptime(tv.daily_metric(t), "wk").select("SignalID", "Week", "uptime")
    return ops.corridor_uptime(weekly, tv.corridors(t), "wk")


@register("d24_monthly_avg_by_day", "SignalID,Month:d,uptime:r,num:r,delta:r",
          """WITH d AS (SELECT SignalID, Date, sum(uptime * num) / sum(num) AS uptime, sum(num) AS num FROM daily_metric GROUP BY ALL),
             a AS (SELECT SignalID, CAST(date_trunc('month', Date) AS DATE) AS Month,
                          sum(uptime * num) / sum(num) AS uptime, sum(num) AS num FROM d GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY SignalID ORDER BY Month") + " FROM a", "daily_metric")
def d24(t):
    return ops.period_avg_by_day(tv.daily_metric(t), "uptime", "mo", "num")


@register("d24_weekly_corridor_avg_by_day", "Zone_Group,Zone,Corridor,Week:d,uptime:r,ones:r,delta:r",
          """WITH d AS (SELECT SignalID, Date, avg(uptime) AS uptime FROM daily_metric GROUP BY ALL),
             w AS (SELECT SignalID, CAST(date_trunc('week', Date) AS DATE) AS Week, avg(uptime) AS uptime, count(*) AS ones
                   FROM d GROUP BY ALL),
             a AS (SELECT Zone_Group, Zone, Corridor, Week, sum(uptime * ones) / sum(ones) AS uptime, sum(ones) AS ones
                   FROM w JOIN corridors USING (SignalID) WHERE Corridor IS NOT NULL GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="uptime", w="PARTITION BY Zone_Group, Zone, Corridor ORDER BY Week") + " FROM a",
          "daily_metric corridors")
def d24b(t):
    weekly = ops.period_avg_by_day(tv.daily_metric(t), "uptime", "wk").drop("delta")
    return ops.corridor_avg_by_day(weekly, tv.corridors(t), "uptime", "Week", "ones")


@register("d26_hourly_by_signal", "SignalID,Hour,vph:r,delta:r,Zone_Group,Zone,Corridor,Subcorridor",
          "SELECT SignalID, Hour, vph, " + DELTA.format(v="vph", w="PARTITION BY SignalID ORDER BY Hour")
          + ", Zone_Group, Zone, Corridor, Subcorridor FROM hourly_metric JOIN corridors USING (SignalID) WHERE Corridor IS NOT NULL",
          "hourly_metric corridors")
def d26(t):
    return ops.hourly_by_signal(tv.hourly_metric(t), "vph", tv.corridors(t))


@register("e01_delta_by_signal_week", "SignalID,Week:d,uptime:r,num:r,delta:r",
          """WITH a AS (SELECT SignalID, CAST(date_trunc('week', Date) AS DATE) AS Week, sum(uptime * num) / sum(num) AS uptime,
                sum(num) AS num FROM daily_metric GROUP BY ALL),
             p AS (SELECT a.*, row_number() OVER (PARTITION BY SignalID ORDER BY Week) AS n FROM a)
---
SELECT c.SignalID, c.Week, c.uptime, c.num, (c.uptime - b.uptime) / nullif(b.uptime, 0) AS delta
FROM p c LEFT JOIN p b ON c.SignalID = b.SignalID AND c.n = b.n + 1""", "daily_metric")
def e01(t):
    return ops.period_avg(tv.daily_metric(t).withColumn("Week", week_start("Date")), "uptime", "Week", "num")


@register("e07_frame_order_delta", "Zone_Group,Zone,Corridor,Month:d,uptime:r,num:r,delta:r",
          f"WITH a AS ({BY_CORRIDOR})\n---\nSELECT *, " + DELTA.format(v="uptime", w="ORDER BY Zone_Group, Zone, Corridor, Month")
          + " FROM a", "daily_metric corridors")
def e07(t):
    return by_corridor(t, lag_scope="frame")


@register("e07_frame_order_delta_by_signal", "SignalID,Month:d,num:r,delta:r",
          """WITH a AS (SELECT SignalID, CAST(date_trunc('month', Date) AS DATE) AS Month, sum(num) AS num FROM daily_metric GROUP BY ALL)
---
SELECT *, """ + DELTA.format(v="num", w="ORDER BY SignalID, Month") + " FROM a", "daily_metric")
def e07b(t):
    return ops.period_sum(monthly(t), "num", "Month", lag_scope="frame")


@register("f04_union_by_name", "SignalID,Month:d,Week:d,uptime:r",
          """SELECT SignalID, CAST(date_trunc('month', Date) AS DATE) AS Month, NULL AS Week, avg(uptime) AS uptime FROM daily_metric GROUP BY ALL
             UNION ALL
             SELECT SignalID, NULL, CAST(date_trunc('week', Date) AS DATE), avg(uptime) FROM daily_metric GROUP BY ALL""",
          "daily_metric")
def f04(t):
    month = ops.signal_uptime(tv.daily_metric(t), "mo").select("SignalID", "Month", "uptime")
    week = ops.signal_uptime(tv.daily_metric(t), "wk").select("SignalID", "Week", "uptime")
    return month.unionByName(week, allowMissingColumns=True)
