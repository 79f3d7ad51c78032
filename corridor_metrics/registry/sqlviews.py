"""The domain views in SQL, and the frame around the reference statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor_metrics.functions.columns import utc_as_naive

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "event_log": ((), """
        SELECT ts AS "timestamp", user_id AS signalid,
               CASE event_type WHEN 'click' THEN 82 WHEN 'view' THEN 81 WHEN 'purchase' THEN 1
                    WHEN 'signup' THEN 90 WHEN 'error' THEN 0 END AS eventcode,
               CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS eventparam
        FROM events"""),
    "det_config": (("event_log",), """
        SELECT DISTINCT signalid, eventparam,
               CASE eventparam WHEN 0 THEN 2 WHEN 1 THEN 6 WHEN 2 THEN 4 END AS CallPhase
        FROM event_log"""),
    "cycle_events": (("event_log",), """
        SELECT "timestamp", signalid, eventcode, CAST(eventparam * 2 AS BIGINT) AS CallPhase FROM event_log"""),
    "places": ((), """
        SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "corridors": (("places",), """
        SELECT c_custkey AS SignalID,
               CASE r_regionkey WHEN 0 THEN 'RTOP1' WHEN 1 THEN 'RTOP2' ELSE r_name END AS Zone_Group,
               CASE n_regionkey * 2 + (n_nationkey // 5) % 2
                    WHEN 0 THEN 'Zone 1' WHEN 1 THEN 'Zone 2' WHEN 2 THEN 'Zone 7m' WHEN 3 THEN 'Zone 7d'
                    WHEN 4 THEN 'Zone 3' WHEN 5 THEN 'Zone 8' WHEN 6 THEN 'Zone 4' WHEN 7 THEN 'Zone 5'
                    WHEN 8 THEN 'Zone 6' WHEN 9 THEN 'Zone 9' END AS Zone,
               CASE WHEN c_custkey % 11 <> 0 THEN n_name END AS Corridor,
               c_mktsegment AS Subcorridor, n_name || ' @ ' || c_mktsegment AS Name
        FROM places"""),
    "counts": ((), """
        SELECT l_suppkey % 20 AS signalid,
               TIMESTAMP '2024-01-01 00:00:00'
                 + to_days(CAST((((CAST(l_shipdate AS DATE) - DATE '1995-01-01') % 30) + 30) % 30 AS INTEGER))
                 + to_minutes(CAST((l_partkey % 96) * 15 AS BIGINT)) AS timeperiod,
               CAST(l_linenumber AS BIGINT) AS eventparam,
               CASE l_linenumber % 4 WHEN 0 THEN 2 WHEN 1 THEN 6 WHEN 2 THEN 4 END AS CallPhase,
               CAST(SUM(l_quantity) AS BIGINT) AS vol
        FROM lineitem GROUP BY ALL"""),
    "counts_with_gaps": (("counts",), """
        SELECT signalid, timeperiod, eventparam, CallPhase,
               CASE WHEN eventparam = 4 AND hour(timeperiod) < 3 THEN NULL ELSE vol END AS vol
        FROM counts"""),
    "report_counts": (("counts",), """
        SELECT signalid AS SignalID, eventparam AS Detector, timeperiod AS Timeperiod, CallPhase, vol,
               CAST(timeperiod AS DATE) AS Date FROM counts"""),
    "daily_metric": ((), """
        SELECT l_suppkey AS SignalID, CAST(l_shipdate AS DATE) AS Date, round(l_discount * 100) AS uptime,
               l_quantity AS num FROM lineitem"""),
    "hourly_metric": ((), """
        SELECT user_id AS SignalID, date_trunc('hour', ts) AS Hour, CAST(SUM(floor(value)) AS DOUBLE) AS vph
        FROM events GROUP BY ALL"""),
    "event_metric": ((), """
        SELECT user_id AS SignalID, ts AS Date_Hour, CAST(ts AS DATE) AS Date, floor(value) AS v FROM events"""),
    "camera_images": ((), """
        SELECT DISTINCT 'CAM-' || user_id AS CameraID,
               timezone('America/New_York', timezone('UTC', date_trunc('second', ts))) AS "Timestamp",
               CAST(floor(value * 100) AS BIGINT) AS Size, CAST(ts AS DATE) AS Date
        FROM events"""),
    "readings": ((), """
        SELECT CAST(l_partkey AS VARCHAR) AS tmc_code,
               TIMESTAMP '2024-01-01 00:00:00'
                 + to_days(CAST((((CAST(l_shipdate AS DATE) - DATE '1995-01-01') % 90) + 90) % 90 AS INTEGER))
                 + to_minutes(CAST(l_orderkey % 1440 AS BIGINT)) AS Minute,
               l_quantity AS speed, CAST(l_linenumber * 10 AS DOUBLE) AS reference_speed
        FROM lineitem"""),
    "segments": ((), """
        SELECT CAST(p_partkey AS VARCHAR) AS tmc, p_retailprice / 1000 AS miles, p_brand AS Corridor,
               CASE WHEN p_type <> 'PROMO' THEN p_type END AS Subcorridor FROM part"""),
    "speeds": (("readings", "segments"), """
        SELECT r.*, s.miles, s.Corridor, coalesce(s.Subcorridor, 'None') AS Subcorridor
        FROM readings r JOIN segments s ON r.tmc_code = s.tmc"""),
    "speed_limits": ((), """
        SELECT DISTINCT p_brand AS Corridor, p_type AS Subcorridor,
               CAST(25 + 5 * (length(p_type) % 5) AS DOUBLE) AS "Speed Limit" FROM part
        UNION ALL
        SELECT DISTINCT p_brand, CAST(NULL AS VARCHAR), CAST(30 + length(p_brand) AS DOUBLE) FROM part"""),
    "injury_reference": ((), """
        SELECT DISTINCT l_quantity AS mph_bin, l_quantity / 100 AS pct FROM lineitem WHERE l_quantity >= 20"""),
    "intersections": ((), """
        SELECT CAST(vec_id AS VARCHAR) AS SignalID, 'Main ' || label AS PrimaryName, 'Side ' || vec_id AS SecondaryName,
               CAST(embedding[1] AS DOUBLE) / 25 AS Longitude, CAST(embedding[2] AS DOUBLE) / 25 AS Latitude
        FROM embeddings WHERE vec_id % 2 = 0"""),
    "locations": ((), """
        SELECT vec_id AS "DB Id", 'Crew ' || label AS "Maintained By", (vec_id - 1) || ' box' AS "Custom Identifier",
               'City ' || (label % 5) AS City, 'County ' || (label % 3) AS County,
               CAST(embedding[1] AS DOUBLE) / 25 AS Longitude, CAST(embedding[2] AS DOUBLE) / 25 AS Latitude
        FROM embeddings WHERE vec_id % 2 = 1"""),
    "progress": ((), """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS Month, o_orderpriority AS Zone,
               o_orderdate AS LastModified, o_orderkey AS entry FROM orders"""),
    "corridor_history": (("places",), """
        SELECT o_custkey AS SignalID,
               CASE r_regionkey WHEN 0 THEN 'RTOP1' WHEN 1 THEN 'RTOP2' ELSE r_name END AS Contract,
               CASE WHEN o_orderkey % 3 = 0 THEN r_name ELSE
                 CASE n_regionkey * 2 + (n_nationkey // 5) % 2
                    WHEN 0 THEN 'Zone 1' WHEN 1 THEN 'Zone 2' WHEN 2 THEN 'Zone 7m' WHEN 3 THEN 'Zone 7d'
                    WHEN 4 THEN 'Zone 3' WHEN 5 THEN 'Zone 8' WHEN 6 THEN 'Zone 4' WHEN 7 THEN 'Zone 5'
                    WHEN 8 THEN 'Zone 6' WHEN 9 THEN 'Zone 9' END END AS District,
               CASE WHEN o_custkey % 11 <> 0 THEN n_name END AS Corridor,
               c_mktsegment AS Subcorridor, 'County' AS Agency, n_name AS main_street, o_orderpriority AS side_street,
               o_totalprice AS Milepost, o_orderdate + to_seconds(o_orderkey % 86400) AS "Asof",
               o_orderkey % 5 <> 0 AS Include,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate ELSE TIMESTAMP '1900-01-01 00:00:00' END AS Modified,
               CAST(o_custkey % 90 AS DOUBLE) AS Latitude, CAST(o_custkey % 180 AS DOUBLE) AS Longitude,
               o_orderkey AS version
        FROM orders JOIN places ON o_custkey = c_custkey"""),
    "mart": (("corridors",), """
        SELECT Zone_Group, Zone, Corridor, CAST(date_trunc('month', o_orderdate) AS DATE) AS Month,
               CAST(SUM(floor(o_totalprice)) AS DOUBLE) AS tp, COUNT(*) AS ones
        FROM orders JOIN corridors ON o_custkey = SignalID WHERE Corridor IS NOT NULL GROUP BY ALL"""),
}


def _ordered(names: tuple[str, ...], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _ordered(VIEWS[name][0], seen)
            if name not in seen:
                seen.append(name)
    return seen


CASTS = {
    "": "{c}",
    "d": "CAST(CAST({c} AS DATE) AS VARCHAR)",
    "r": "round(CAST({c} AS DOUBLE), {digits})",
    "i": "CAST({c} AS BIGINT)",
    "t": "CAST({c} AS TIMESTAMP)",
}


DIGITS = 8


def oracle(columns: str, body: str, use: str = "", digits: int = DIGITS) -> str:
    """``WITH`` the used views, the body as ``q``, and the typed result columns.

    ``columns`` lists ``name`` or ``name:type``: d date text, r rounded double,
    i bigint, t timestamp.
    """
    views = [f"{name} AS ({VIEWS[name][1]})" for name in _ordered(tuple(use.split()), [])]
    body = body.strip()
    if body[:5].upper() == "WITH ":
        head, body = body[5:].rsplit("\n---\n", 1)
        views.append(head.strip())
    views.append(f"q AS ({body})")
    out = []
    for spec in columns.split(","):
        name, _, kind = spec.strip().partition(":")
        out.append(f'{CASTS[kind].format(c=chr(34) + name + chr(34), digits=digits)} AS "{name}"')
    return "WITH " + ",\n".join(views) + "\nSELECT " + ", ".join(out) + " FROM q"


def _canonical(field: T.StructField, digits: int) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DoubleType | T.FloatType):
        c = F.round(c.cast("double"), digits)
    elif isinstance(field.dataType, T.DateType):
        c = c.cast("string")
    elif isinstance(field.dataType, T.TimestampType):
        c = utc_as_naive(c)
    return c.alias(field.name)


def canonical(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to fixed places, dates as text, instants as UTC wall time: one form in both engines."""
    return df.select(*[_canonical(f, digits) for f in df.schema.fields])
