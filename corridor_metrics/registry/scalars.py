"""Scalar-function, calendar and series queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.functions import columns as fn
from corridor_metrics.functions import dates
from corridor_metrics.operators import marts
from corridor_metrics.registry import register


@register("s01_time_slots", "event_id,minute,quarter,hour",
          """SELECT event_id, date_trunc('minute', ts) AS minute, time_bucket(INTERVAL 15 MINUTE, ts) AS quarter,
             date_trunc('hour', ts) AS hour FROM events""")
def s01(t):
    return t.events.select(
        "event_id", fn.floor_minutes("ts", 1).alias("minute"), fn.floor_to_unit("ts", "15min").alias("quarter"),
        fn.floor_to_unit("ts", "hours").alias("hour"),
    )


@register("s02_calendar_parts", "o_orderkey,week,dow1,dow0,h,d:d,y,m",
          """SELECT o_orderkey, weekofyear(o_orderdate) AS week, isodow(o_orderdate) AS dow1, isodow(o_orderdate) - 1 AS dow0,
             hour(o_orderdate) AS h, CAST(o_orderdate AS DATE) AS d, year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders""")
def s02(t):
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey", fn.iso_week(d).alias("week"), fn.dow_monday1(d).alias("dow1"), fn.dow_monday0(d).alias("dow0"),
        F.hour(d).alias("h"), F.to_date(d).alias("d"), F.year(d).alias("y"), F.month(d).alias("m"),
    )


@register("s03_recent_monday", "event_id,monday:d,monday_time",
          """SELECT event_id, date_trunc('week', ts) AS monday, ts - to_days(CAST(isodow(ts) - 1 AS INTEGER)) AS monday_time FROM events""")
def s03(t):
    return t.events.select("event_id", fn.week_start("ts").alias("monday"), fn.recent_monday("ts").alias("monday_time"))


@register("s04_naive_to_utc", "event_id,ts,micros",
          "SELECT event_id, ts, epoch_us(ts) AS micros FROM events")
def s04(t):
    return fn.all_to_utc(t.events.select("event_id", "ts")).withColumn("micros", F.unix_micros("ts"))


@register("s07_first_missing_date", "event_type,start:d,first_missing:d",
          """SELECT event_type, CAST(min(ts) AS DATE) AS start, least(CAST(max(ts) AS DATE) + 1, DATE '2024-01-30') AS first_missing
             FROM events GROUP BY event_type""")
def s07(t):
    days = t.events.select("event_type", F.to_date("ts").alias("date"))
    missing = dates.resolve_date("first_missing", dt.date(2024, 1, 31), days)
    return days.groupBy("event_type").agg(F.min("date").alias("start")).withColumn("first_missing", F.lit(missing))


@register("s08_month_bounds", "o_orderkey,month_start:d,month_end:d,last_month:d,year_back:d",
          """SELECT o_orderkey, date_trunc('month', o_orderdate) AS month_start, last_day(CAST(o_orderdate AS DATE)) AS month_end,
             date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS last_month, date_trunc('month', o_orderdate) - INTERVAL 12 MONTH AS year_back
             FROM orders""")
def s08(t):
    start = fn.month_start("o_orderdate")
    return t.orders.select(
        "o_orderkey", start.alias("month_start"), fn.month_end("o_orderdate").alias("month_end"),
        F.add_months(start, -1).alias("last_month"), F.add_months(start, -12).alias("year_back"),
    )


@register("s09_date_floor", "o_orderkey,d:d",
          "SELECT o_orderkey, greatest(CAST(o_orderdate AS DATE), DATE '1997-01-01') AS d FROM orders")
def s09(t):
    return t.orders.select("o_orderkey", fn.not_before(F.to_date("o_orderdate"), "1997-01-01").alias("d"))


@register("s10_text_functions", "c_custkey,name,description,alert,lane,token,zone",
          """WITH n AS (SELECT c_custkey, trim(' ' || c_name || '  ') AS nm, c_mktsegment AS seg,
                CASE WHEN c_custkey % 4 = 0 THEN 'Ramp Meter' ELSE c_mktsegment END AS cor,
                CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 4 END AS lane FROM customer)
---
SELECT c_custkey, nm || ' @ ' || seg AS name, c_custkey || ': ' || nm || ' @ ' || seg AS description,
       CASE WHEN cor = 'Ramp Meter' THEN replace(nm || ' @ ' || seg, '@', '-') ELSE nm || ' @ ' || seg END AS alert,
       trim(lower(seg) || CASE WHEN lane IS NULL THEN '' ELSE ' Lane ' || lane END) AS lane,
       split_part(nm || ' x', ' ', 1) AS token, seg LIKE 'M%' AS zone FROM n""")
def s10(t):
    nm = F.trim(F.concat(F.lit(" "), "c_name", F.lit("  ")))
    cor = F.when(F.col("c_custkey") % 4 == 0, F.lit("Ramp Meter")).otherwise(F.col("c_mktsegment"))
    lane = F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey") % 4)
    name = fn.crossing_name(nm, "c_mktsegment")
    return t.customer.select(
        "c_custkey", name.alias("name"), fn.labelled("c_custkey", name).alias("description"),
        fn.alert_name(name, cor).alias("alert"), fn.lane_text(F.lower("c_mktsegment"), lane).alias("lane"),
        fn.first_token(F.concat(nm, F.lit(" x"))).alias("token"), F.col("c_mktsegment").startswith("M").alias("zone"),
    )


@register("s11_path_parts", "event_id,date:d,SignalID",
          "SELECT event_id, CAST(ts AS DATE) AS date, user_id AS SignalID FROM events")
def s11(t):
    path = F.concat(F.lit("lake/atspm/date="), F.to_date("ts"), F.lit("/atspm_"), "user_id", F.lit("_x.parquet"))
    return t.events.select("event_id", fn.path_date(path).alias("date"), fn.path_number(path, "atspm_").alias("SignalID"))


@register("s15_display_formats", "l_orderkey,l_linenumber,l_partkey,whole,two,pct,money,chosen,tick",
          """SELECT l_orderkey, l_linenumber, l_partkey, format('{:,}', CAST(trunc(l_extendedprice) AS BIGINT)) AS whole,
             printf('%.2f', l_extendedprice) AS two, printf('%.1f%%', l_discount * 100) AS pct,
             '$' || format('{:,.2f}', l_extendedprice) AS money,
             CASE l_linenumber % 3 WHEN 0 THEN format('{:,}', CAST(trunc(l_quantity) AS BIGINT)) WHEN 1 THEN printf('%.2f', l_quantity)
                  ELSE printf('%.1f%%', l_quantity * 100) END AS chosen,
             CASE l_linenumber % 3 WHEN 0 THEN ',.0' WHEN 1 THEN '.2f' ELSE '.0%' END AS tick FROM lineitem""")
def s15(t):
    line = F.col("l_linenumber") % 3
    kind = F.when(line == 0, "integer").when(line == 1, "decimal").otherwise("percent")
    return t.lineitem.withColumn("kind", kind).select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.as_int("l_extendedprice").alias("whole"),
        fn.as_2dec("l_extendedprice").alias("two"), fn.as_pct("l_discount").alias("pct"),
        fn.as_currency("l_extendedprice").alias("money"), fn.data_format("l_quantity", "kind").alias("chosen"),
        fn.tick_format("kind").alias("tick"),
    )


@register("s17_null_fills", "SignalID,Corridor,Description,phase",
          """SELECT SignalID, coalesce(Corridor, 'None') AS Corridor,
             coalesce(CASE WHEN Corridor IS NOT NULL THEN Name END, SignalID || ': ' || Zone) AS Description,
             coalesce(CASE WHEN SignalID % 3 = 0 THEN SignalID % 8 END, 0) AS phase FROM corridors""", "corridors")
def s17(t):
    rows = tv.corridors(t).withColumn("phase", F.when(F.col("SignalID") % 3 == 0, F.col("SignalID") % 8))
    described = rows.withColumn(
        "Description",
        F.coalesce(F.when(F.col("Corridor").isNotNull(), F.col("Name")), fn.labelled("SignalID", "Zone")),
    )
    return described.fillna({"Corridor": "None", "phase": 0}).select("SignalID", "Corridor", "Description", "phase")


@register("s21_rounding", "l_orderkey,l_linenumber,l_partkey,cut,low,even:r",
          """SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc(l_extendedprice) AS BIGINT) AS cut,
             CAST(floor(l_extendedprice / 3) AS BIGINT) AS low, round_even(l_quantity / 2, 0) AS even FROM lineitem""")
def s21(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("long").alias("cut"),
        F.floor(F.col("l_extendedprice") / 3).alias("low"), F.bround(F.col("l_quantity") / 2, 0).alias("even"),
    )


@register("f05_distinct_signals", "SignalID", "SELECT DISTINCT signalid AS SignalID FROM event_log", "event_log")
def f05(t):
    from corridor_metrics.sources.lake import all_signals

    per_date = tv.event_log(t).select(F.to_date("timestamp").alias("date"), F.col("signalid").alias("SignalID")).distinct()
    return all_signals(per_date)


@register("f07_calendar_days_and_months", "Zone,month:d,label,days",
          """WITH r AS (SELECT o_orderpriority AS Zone, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY ALL),
             d AS (SELECT Zone, unnest(generate_series(CAST(a AS TIMESTAMP), b, INTERVAL 1 DAY)) AS day FROM r)
---
SELECT Zone, CAST(date_trunc('month', day) AS DATE) AS month, strftime(date_trunc('month', day), '%Y-%m') AS label, count(*) AS days
FROM d GROUP BY ALL""")
def f07(t):
    spans = t.orders.groupBy(F.col("o_orderpriority").alias("Zone")).agg(
        F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")
    )
    days = fn.calendar(spans, F.col("a"), F.col("b"), "day")
    months = days.groupBy("Zone", fn.month_start("day").alias("month")).agg(F.count("*").alias("days"))
    return months.select("Zone", "month", F.date_format("month", "yyyy-MM").alias("label"), "days")


@register("f08_series_ends", "Zone_Group,Corridor,first:r,last:r",
          "SELECT Zone_Group, Corridor, arg_min(tp, Month) AS first, arg_max(tp, Month) AS last FROM mart GROUP BY ALL", "mart")
def f08(t):
    return marts.series_ends(tv.mart(t), "tp", ["Zone_Group", "Corridor"])
