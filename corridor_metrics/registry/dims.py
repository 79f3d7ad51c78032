"""Dimension, configuration, hygiene and alert queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.operators import alerts, dims, filters
from corridor_metrics.operators.counts import filtered_counts
from corridor_metrics.operators.filters import report_names
from corridor_metrics.registry import register

HISTORY = "SignalID,District,Contract,Corridor,Subcorridor,version"


def history(t):
    return tv.corridor_history(t)


@register("b08_signals_in_use", HISTORY,
          "SELECT * FROM corridor_history WHERE SignalID > 0 AND Include", "corridor_history")
def b08(t):
    rows = filters.real_signals(dims.trimmed(history(t)))
    return rows.select(F.col("SignalID").cast("long").alias("SignalID"), "District", "Contract", "Corridor", "Subcorridor", "version")


@register("b08_marked_contracts", HISTORY,
          "SELECT * FROM corridor_history WHERE Contract = District OR Contract IN ('RTOP1', 'RTOP2')", "corridor_history")
def b08b(t):
    rows = filters.marked_contracts(dims.trimmed(history(t)))
    return rows.select(F.col("SignalID").cast("long").alias("SignalID"), "District", "Contract", "Corridor", "Subcorridor", "version")


LATEST = """SELECT * FROM corridor_history WHERE SignalID > 0 AND Include
    QUALIFY row_number() OVER (PARTITION BY SignalID, District, Corridor ORDER BY Modified DESC, "Asof" DESC) = 1"""


@register("e10_latest_per_key", "SignalID,District,Corridor,version",
          """WITH m AS (SELECT SignalID, District, Corridor, max(Modified) AS Modified FROM corridor_history GROUP BY ALL),
             a AS (SELECT h.SignalID, h.District, h.Corridor, h.Modified, max("Asof") AS "Asof" FROM corridor_history h JOIN m
                   ON h.SignalID = m.SignalID AND h.District = m.District AND h.Corridor IS NOT DISTINCT FROM m.Corridor
                   AND h.Modified = m.Modified GROUP BY ALL)
---
SELECT h.SignalID, h.District, h.Corridor, max(version) AS version FROM corridor_history h JOIN a
ON h.SignalID = a.SignalID AND h.District = a.District AND h.Corridor IS NOT DISTINCT FROM a.Corridor
AND h.Modified = a.Modified AND h."Asof" = a."Asof" GROUP BY ALL""", "corridor_history")
def e10(t):
    rows = dims.trimmed(history(t)).withColumn(
        "Modified", F.coalesce("Modified", F.lit("1900-01-01 00:00:00").cast("timestamp_ntz"))
    )
    out = dims.latest_by(rows, ["SignalID", "District", "Corridor"], F.desc("Modified"), F.desc("Asof"), F.desc("version"))
    return out.select(F.col("SignalID").cast("long").alias("SignalID"), "District", "Corridor", "version")


@register("g09_corridor_dimension",
          "SignalID,District,Contract,Corridor,Subcorridor,Milepost:r,Agency,Name,Asof,Latitude:r,Longitude:r,Description",
          f"""WITH l AS ({LATEST})
---
SELECT *, main_street || ' @ ' || side_street AS Name, SignalID || ': ' || main_street || ' @ ' || side_street AS Description
FROM l WHERE Corridor IS NOT NULL""", "corridor_history", digits=2)
def g09(t):
    return dims.corridor_dimension(history(t))


@register("d20_corridors_in_several_zones", "District,Contract,Corridor",
          """WITH d AS (SELECT DISTINCT District, Contract, Corridor FROM corridor_history WHERE Corridor IS NOT NULL)
---
SELECT * FROM d WHERE Corridor IN (SELECT Corridor FROM d GROUP BY Corridor HAVING count(*) > 1)""", "corridor_history")
def d20(t):
    return dims.corridor_conflicts(dims.trimmed(history(t)))["zones"]


@register("d20_corridors_differing_by_case", "District,Contract,Corridor",
          """WITH d AS (SELECT DISTINCT District, Contract, CASE WHEN version % 7 = 0 THEN lower(Corridor) ELSE Corridor END AS Corridor
                FROM corridor_history WHERE Corridor IS NOT NULL)
---
SELECT * FROM d WHERE lower(Corridor) IN (SELECT lower(Corridor) FROM d GROUP BY 1 HAVING count(*) > 1)""", "corridor_history")
def d20b(t):
    name = F.when(F.col("version") % 7 == 0, F.lower("Corridor")).otherwise(F.col("Corridor"))
    return dims.corridor_conflicts(dims.trimmed(history(t)).withColumn("Corridor", name))["case"]


def cameras(t):
    return t.orders.select(
        F.when(F.col("o_orderkey") % 13 != 0, F.concat(F.lit("CAM-"), F.col("o_custkey") % 500)).alias("CameraID"),
        F.concat(F.lit("Pole "), F.col("o_custkey") % 7).alias("Location"),
        F.col("o_custkey").alias("MaxView ID"), F.col("o_orderdate").alias("As_of_Date"),
        (F.col("o_orderkey") % 3 != 0).alias("Include"),
    )


CAMERA_PLACE = """c AS (SELECT SignalID, Zone_Group AS Contract, Zone AS District, Corridor, Subcorridor FROM corridors)"""


@register("c07_cameras_in_corridors",
          "SignalID,Contract,District,Corridor,Subcorridor,CameraID,Location,As_of_Date,MaxView ID,Description",
          """WITH cam AS (SELECT DISTINCT CASE WHEN o_orderkey % 13 <> 0 THEN 'CAM-' || (o_custkey % 500) END AS CameraID,
                'Pole ' || (o_custkey % 7) AS Location, o_custkey AS "MaxView ID", o_orderdate AS As_of_Date
                FROM orders WHERE o_orderkey % 3 <> 0), """ + CAMERA_PLACE + """
---
SELECT c.*, cam.*, CameraID || ': ' || Location AS Description FROM c LEFT JOIN cam ON c.SignalID = cam."MaxView ID"
WHERE CameraID IS NOT NULL""", "corridors")
def c07(t):
    place = tv.corridors(t).withColumnsRenamed({"Zone_Group": "Contract", "Zone": "District"})
    return dims.camera_config(cameras(t), place)


def dated_config(t):
    """Detector configuration by day: what a detector reported as its parameter that day."""
    return t.events.select(
        F.to_date("ts").alias("date"), F.col("user_id").alias("SignalID"),
        (F.get_json_object("props", "$.k").cast("long") % 10).alias("Detector"),
        F.when(F.col("event_id") % 5 != 0, (F.col("event_id") % 4 * 2).cast("int")).alias("CallPhase"),
        F.concat(F.lit("App "), F.col("event_id") % 3).alias("ApproachDesc"),
        F.when(F.col("event_id") % 6 != 0, (F.col("event_id") % 3 + 1).cast("int")).alias("LaneNumber"),
        F.col("event_id").alias("line"),
    )


CONFIG = """cfg AS (SELECT CAST(ts AS DATE) AS date, user_id AS SignalID,
    CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS Detector,
    CASE WHEN event_id % 5 <> 0 THEN event_id % 4 * 2 END AS CallPhase, 'App ' || (event_id % 3) AS ApproachDesc,
    CASE WHEN event_id % 6 <> 0 THEN event_id % 3 + 1 END AS LaneNumber, event_id AS line FROM events)"""


@register("d19_first_phase_per_detector", "SignalID,Detector,CallPhase",
          "WITH " + CONFIG + "\n---\nSELECT SignalID, Detector, arg_min(CallPhase, line) FILTER (WHERE CallPhase IS NOT NULL) AS CallPhase FROM cfg GROUP BY ALL")
def d19(t):
    return dims.first_config(dated_config(t), "line")


@register("g10_detector_config_of_a_day", "SignalID,Detector,CallPhase",
          "WITH " + CONFIG + """
---
SELECT SignalID, Detector, arg_min(CallPhase, line) FILTER (WHERE CallPhase IS NOT NULL) AS CallPhase FROM cfg
WHERE date = DATE '2024-01-10' GROUP BY ALL""")
def g10(t):
    return dims.det_config_on(dated_config(t), dt.date(2024, 1, 10), "line")


@register("g10_ped_config_of_a_day", "SignalID,Detector,CallPhase",
          "WITH " + CONFIG + """
---
SELECT SignalID, Detector, arg_min(CallPhase, line) FILTER (WHERE CallPhase IS NOT NULL) AS CallPhase FROM cfg
WHERE date = DATE '2024-01-11' GROUP BY ALL""")
def g10b(t):
    return dims.ped_config_on(dated_config(t), dt.date(2024, 1, 11), "line")


@register("c14_latest_config_as_of", "date:d,SignalID,Detector,CallPhase,line",
          "WITH " + CONFIG + "\n---\nSELECT * FROM cfg WHERE date = (SELECT max(date) FROM cfg WHERE date <= DATE '2024-01-18')")
def c14(t):
    return dims.latest_det_config(dated_config(t), dt.date(2024, 1, 18)).select("date", "SignalID", "Detector", "CallPhase", "line")


TODAY = dt.date(2024, 1, 28)


def bad_rows(t):
    """Detector-days with a bad period."""
    flagged = report_names(filtered_counts(tv.counts(t), "15 min", thresholds=tv.THRESHOLDS))
    return flagged.where(~F.col("Good_Day")).select("SignalID", "Detector", F.to_date("Timeperiod").alias("Date")).distinct()


def one_config(t):
    keys = ["date", "SignalID", "Detector"]
    return dims.latest_by(dated_config(t), keys, F.asc("line")).withColumnRenamed("date", "Date").drop("line")


BAD = """fl AS (SELECT signalid, CallPhase, eventparam, timeperiod, vol,
        lag(vol) OVER (PARTITION BY signalid, CallPhase, eventparam ORDER BY timeperiod) AS prev FROM counts),
    fx AS (SELECT *, sum(CASE WHEN vol = prev THEN 1 ELSE 0 END) OVER (PARTITION BY signalid, CallPhase, eventparam ORDER BY timeperiod) AS run FROM fl),
    bad AS (SELECT DISTINCT signalid AS SignalID, eventparam AS Detector, CAST(timeperiod AS DATE) AS Date FROM fx
            WHERE vol > 60 OR abs(vol - prev) > 40 OR (CallPhase IS NOT NULL AND run > 3)),
    recent AS (SELECT * FROM bad WHERE Date BETWEEN DATE '2023-10-30' AND DATE '2024-01-27')"""
ONE = """one AS (SELECT * FROM cfg QUALIFY row_number() OVER (PARTITION BY date, SignalID, Detector ORDER BY line) = 1)"""


@register("c13_config_of_the_same_date", "SignalID,Detector,Date:d,CallPhase,ApproachDesc,LaneNumber",
          f"WITH {CONFIG}, {ONE}, {BAD}" + """
---
SELECT b.*, CallPhase, ApproachDesc, LaneNumber FROM bad b LEFT JOIN one o
ON b.SignalID = o.SignalID AND b.Detector = o.Detector AND b.Date = o.date""", "counts")
def c13(t):
    return alerts.dated_config(bad_rows(t), one_config(t))


@register("c13_config_in_force", "SignalID,Detector,Date:d,CallPhase,ApproachDesc,LaneNumber",
          f"WITH {CONFIG}, {ONE}, {BAD}" + """
---
SELECT b.*, CallPhase, ApproachDesc, LaneNumber FROM bad b ASOF LEFT JOIN (SELECT * FROM one WHERE day(date) % 4 = 1) o
ON b.SignalID = o.SignalID AND b.Detector = o.Detector AND b.Date >= o.date""", "counts")
def c13b(t):
    return alerts.config_as_of(bad_rows(t), one_config(t).where(F.dayofmonth("Date") % 4 == 1))


@register("c14_config_of_every_day", "date:d,config_date:d,lines",
          "WITH " + CONFIG + """, few AS (SELECT * FROM cfg WHERE day(date) % 7 = 2),
             days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
             latest AS (SELECT d.date, (SELECT max(s.date) FROM few s WHERE s.date <= d.date) AS config_date FROM days d)
---
SELECT l.date, l.config_date, count(*) AS lines FROM latest l JOIN few s ON s.date = l.config_date GROUP BY ALL""")
def c14b(t):
    config = dated_config(t)
    rows = dims.det_config_of_days(config.select("date"), config.where(F.dayofmonth("date") % 7 == 2))
    return rows.groupBy("date", "config_date").agg(F.count("*").alias("lines"))


ALERT = f"""WITH {CONFIG}, {ONE}, {BAD}, j AS (SELECT b.SignalID, b.Detector, b.Date, o.CallPhase, o.ApproachDesc, o.LaneNumber
    FROM recent b LEFT JOIN one o ON b.SignalID = o.SignalID AND b.Detector = o.Detector AND b.Date = o.date)"""


@register("c08_bad_detectors_with_config_and_corridor",
          "SignalID,Detector,Date:d,CallPhase,Zone_Group,Zone,Corridor",
          ALERT + "\n---\nSELECT j.*, Zone_Group, Zone, Corridor FROM j LEFT JOIN corridors USING (SignalID) WHERE Corridor IS NOT NULL",
          "counts corridors")
def c08(t):
    return alerts.vehicle_alerts(bad_rows(t), one_config(t), tv.corridors(t), TODAY).select(
        "SignalID", "Detector", "Date", "CallPhase", "Zone_Group", "Zone", "Corridor"
    )


def ramp_corridors(t):
    """Corridors with some ramp meters among them."""
    ramp = F.when(F.col("SignalID") % 3 == 1, F.lit("Ramp Meter")).otherwise(F.col("Corridor"))
    return tv.corridors(t).withColumn("Corridor", F.when(F.col("Corridor").isNotNull(), ramp))


RAMP = """r AS (SELECT SignalID, Zone_Group, Zone, Name,
    CASE WHEN Corridor IS NOT NULL THEN CASE WHEN SignalID % 3 = 1 THEN 'Ramp Meter' ELSE Corridor END END AS Corridor FROM corridors)"""


@register("g11_watchdog_vehicle_alerts",
          "Zone_Group,Zone,Corridor,SignalID,CallPhase,Detector,Date:d,Alert,Name,ApproachDesc",
          ALERT + ", " + RAMP + """
---
SELECT Zone_Group, Zone, Corridor, j.SignalID, CallPhase, Detector, Date, 'Bad Vehicle Detection' AS Alert,
       CASE WHEN Corridor = 'Ramp Meter' THEN replace(Name, '@', '-') ELSE Name END AS Name,
       trim(coalesce(ApproachDesc, '') || CASE WHEN LaneNumber IS NULL THEN '' ELSE ' Lane ' || LaneNumber END) AS ApproachDesc
FROM j JOIN r ON j.SignalID = r.SignalID WHERE Corridor IS NOT NULL""", "counts corridors")
def g11(t):
    return alerts.vehicle_alerts(bad_rows(t), one_config(t), ramp_corridors(t), TODAY)


@register("c09_bad_ped_detectors_with_corridor", "Zone_Group,Zone,Corridor,SignalID,Detector,Date:d,Alert,Name",
          f"WITH {BAD}" + """
---
SELECT Zone_Group, Zone, Corridor, b.SignalID, Detector, Date, 'Bad Ped Detection' AS Alert, Name
FROM recent b LEFT JOIN corridors USING (SignalID)""", "counts corridors")
def c09(t):
    return alerts.ped_alerts(bad_rows(t), tv.corridors(t), TODAY)


@register("f01_sorted_output", "SignalID,Timeperiod,Detector,vol,CallPhase,Date:d",
          "SELECT * FROM report_counts ORDER BY SignalID, Detector, Timeperiod", "report_counts")
def f01(t):
    return tv.report_counts(t).orderBy("SignalID", "Detector", "Timeperiod")
