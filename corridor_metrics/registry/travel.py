"""Speed and safety index queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.operators import filters, scale
from corridor_metrics.operators import travel as ops
from corridor_metrics.plans import travel_jobs
from corridor_metrics.registry import register

TIMES = """SELECT DISTINCT r.tmc_code, r.Minute, r.speed, r.reference_speed, s.miles, s.Corridor,
    coalesce(s.Subcorridor, 'None') AS Subcorridor, s.miles / nullif(r.reference_speed, 0) * 60 AS reference_minutes
    FROM readings r JOIN segments s ON r.tmc_code = s.tmc WHERE s.Corridor IS NOT NULL"""
TIME_COLUMNS = "tmc_code,Minute,speed:r,reference_speed:r,miles:r,Corridor,Subcorridor,reference_minutes:r"


@register("c04_join_segments", "tmc_code,Minute,speed:r,reference_speed:r,miles:r,Corridor,Subcorridor",
          """SELECT r.*, s.miles, s.Corridor, s.Subcorridor FROM readings r JOIN segments s ON r.tmc_code = s.tmc""", "readings segments")
def c04(t):
    readings = tv.readings(t).withColumnRenamed("measurement_tstamp", "Minute")
    segments = tv.segments(t).withColumnRenamed("tmc", "tmc_code")
    return scale.checked_join(readings, segments, ["tmc_code"])


@register("g18_travel_times", TIME_COLUMNS, TIMES, "readings segments")
def g18(t):
    return ops.travel_times(tv.readings(t), tv.segments(t))


@register("s18_reference_minutes", "tmc_code,Minute,reference_minutes:r",
          "SELECT tmc_code, Minute, miles / nullif(reference_speed, 0) * 60 AS reference_minutes FROM speeds", "speeds")
def s18(t):
    from corridor_metrics.functions.measures import ratio

    return tv.speeds(t).select("tmc_code", "Minute", (ratio(F.col("miles"), F.col("reference_speed")) * 60).alias("reference_minutes"))


@register("f02_distinct_readings", "speed:r,reference_speed:r,Corridor,Subcorridor",
          "SELECT DISTINCT speed, reference_speed, Corridor, Subcorridor FROM speeds", "speeds")
def f02(t):
    return tv.speeds(t).select("speed", "reference_speed", "Corridor", "Subcorridor").distinct()


P90 = """WITH p AS (SELECT {g}, quantile_cont(speed, 0.9) AS p90 FROM speeds GROUP BY ALL)
---
SELECT {g}, p90 AS speed, "Speed Limit", p90 / nullif("Speed Limit", 0) AS rsi FROM p JOIN {limits} USING ({g})"""


@register("d08_relative_speed_index_subcorridor", "Corridor,Subcorridor,speed:r,Speed Limit:r,rsi:r",
          P90.format(g="Corridor, Subcorridor", limits="speed_limits"), "speeds speed_limits")
def d08(t):
    return ops.relative_speed_index(tv.speeds(t), tv.speed_limits(t), ["Corridor", "Subcorridor"])


@register("d08_relative_speed_index_corridor", "Corridor,speed:r,Speed Limit:r,rsi:r",
          P90.format(g="Corridor", limits="(SELECT * FROM speed_limits WHERE Subcorridor IS NULL)"), "speeds speed_limits")
def d08b(t):
    return ops.relative_speed_index(tv.speeds(t), ops.corridor_limits(tv.speed_limits(t)), ["Corridor"])


@register("c05_join_speed_limits", "Corridor,Subcorridor,n,Speed Limit:r",
          """SELECT Corridor, Subcorridor, n, "Speed Limit" FROM (SELECT Corridor, Subcorridor, count(*) AS n FROM speeds GROUP BY ALL)
             JOIN speed_limits USING (Corridor, Subcorridor)""", "speeds speed_limits")
def c05(t):
    grouped = tv.speeds(t).groupBy("Corridor", "Subcorridor").agg(F.count("*").alias("n"))
    return scale.checked_join(grouped, tv.speed_limits(t), ["Corridor", "Subcorridor"])


SAFETY = "(speed >= 20 AND (hour(Minute) BETWEEN 9 AND 10 OR hour(Minute) BETWEEN 19 AND 20))"


@register("b07_safety_speed_rows", "tmc_code,Corridor,Subcorridor,Minute,speed:r,hr",
          f"SELECT tmc_code, Corridor, Subcorridor, Minute, speed, hour(Minute) AS hr FROM speeds WHERE {SAFETY}", "speeds")
def b07(t):
    return filters.safety_speeds(tv.speeds(t))


SHARES = """WITH f AS (SELECT * FROM speeds WHERE """ + SAFETY + """),
    n AS (SELECT {g}, speed, count(*) AS c FROM f GROUP BY ALL), w AS (SELECT {g}, count(*) AS totals FROM f GROUP BY ALL)"""


@register("c15_group_totals_on_bins", "Corridor,speed:r,totals,count_pct:r",
          SHARES.format(g="Corridor") + "\n---\nSELECT n.Corridor, speed, totals, c / totals AS count_pct FROM n JOIN w USING (Corridor)", "speeds")
def c15(t):
    return ops.speed_shares(filters.safety_speeds(tv.speeds(t)), ["Corridor"])


@register("d25_group_row_counts", "Corridor,Subcorridor,speed:r,totals,count_pct:r",
          SHARES.format(g="Corridor, Subcorridor")
          + "\n---\nSELECT n.Corridor, n.Subcorridor, speed, totals, c / totals AS count_pct FROM n JOIN w USING (Corridor, Subcorridor)",
          "speeds")
def d25(t):
    return ops.speed_shares(filters.safety_speeds(tv.speeds(t)), ["Corridor", "Subcorridor"])


@register("c06_join_speed_bins", "Corridor,speed:r,totals,count_pct:r,pct:r",
          SHARES.format(g="Corridor") + """
---
SELECT n.Corridor, speed, totals, c / totals AS count_pct, pct FROM n JOIN w USING (Corridor) JOIN injury_reference ON speed = mph_bin""",
          "speeds injury_reference")
def c06(t):
    bins = tv.injury_reference(t).withColumnRenamed("mph_bin", "speed")
    return scale.checked_join(c15(t), bins, ["speed"])


@register("d09_serious_injury_pct_subcorridor", "Corridor,Subcorridor,overall_pct:r",
          SHARES.format(g="Corridor, Subcorridor") + """
---
SELECT n.Corridor, n.Subcorridor, sum(c / totals * pct) AS overall_pct FROM n JOIN w USING (Corridor, Subcorridor)
JOIN injury_reference ON speed = mph_bin GROUP BY ALL""", "speeds injury_reference")
def d09(t):
    return ops.serious_injury_pct(filters.safety_speeds(tv.speeds(t)), tv.injury_reference(t), ["Corridor", "Subcorridor"])


@register("d09_serious_injury_pct_all_bins", "Corridor,overall_pct:r",
          """WITH n AS (SELECT Corridor, speed, count(*) AS c FROM speeds GROUP BY ALL), w AS (SELECT Corridor, count(*) AS totals FROM speeds GROUP BY ALL)
---
SELECT n.Corridor, sum(c / totals * pct) AS overall_pct FROM n JOIN w USING (Corridor)
JOIN injury_reference ON speed = mph_bin GROUP BY ALL""", "speeds injury_reference")
def d09b(t):
    return ops.serious_injury_pct(tv.speeds(t), tv.injury_reference(t), ["Corridor"])


@register("g18_monthly_relative_speed_index", "month:d,Corridor,speed:r,Speed Limit:r,rsi:r",
          """WITH p AS (SELECT CAST(date_trunc('month', Minute) AS DATE) AS month, Corridor, quantile_cont(speed, 0.9) AS p90 FROM speeds GROUP BY ALL)
---
SELECT month, Corridor, p90 AS speed, "Speed Limit", p90 / nullif("Speed Limit", 0) AS rsi
FROM p JOIN (SELECT * FROM speed_limits WHERE Subcorridor IS NULL) USING (Corridor)""", "speeds speed_limits")
def g18b(t):
    return travel_jobs.speed_indices(tv.speeds(t), tv.speed_limits(t), tv.injury_reference(t))["rsi_cor"]


@register("g18_monthly_safety_index", "month:d,Corridor,overall_pct:r",
          """WITH f AS (SELECT *, CAST(date_trunc('month', Minute) AS DATE) AS month FROM speeds WHERE """ + SAFETY + """),
    n AS (SELECT month, Corridor, speed, count(*) AS c FROM f GROUP BY ALL), w AS (SELECT month, Corridor, count(*) AS totals FROM f GROUP BY ALL)
---
SELECT n.month, n.Corridor, sum(c / totals * pct) AS overall_pct FROM n JOIN w USING (month, Corridor)
JOIN injury_reference ON speed = mph_bin GROUP BY ALL""", "speeds injury_reference")
def g18c(t):
    return travel_jobs.speed_indices(tv.speeds(t), tv.speed_limits(t), tv.injury_reference(t))["bpsi_cor"]
