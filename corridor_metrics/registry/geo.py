"""Nearest-location, line and map-layer queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corridor_metrics import testviews as tv
from corridor_metrics.functions import columns as fn
from corridor_metrics.operators import filters, geo
from corridor_metrics.operators.scale import checked_join
from corridor_metrics.registry import register

NEAREST = """near AS (SELECT i.SignalID, i.PrimaryName, i.SecondaryName, l."DB Id",
        sqrt((i.Longitude - l.Longitude) * (i.Longitude - l.Longitude) + (i.Latitude - l.Latitude) * (i.Latitude - l.Latitude)) * 111139 AS d
    FROM intersections i CROSS JOIN locations l
    QUALIFY row_number() OVER (PARTITION BY i.SignalID ORDER BY d, l."DB Id") = 1),
    close AS (SELECT *, CAST(floor(d) AS INTEGER) AS m FROM near WHERE d < 100)"""


@register("c10_nearest_location", "SignalID,PrimaryName,SecondaryName,DB Id,m",
          "WITH " + NEAREST + "\n---\nSELECT * FROM close", "intersections locations")
def c10(t):
    return geo.nearest_location(tv.intersections(t), tv.locations(t)).select(
        "SignalID", "PrimaryName", "SecondaryName", "DB Id", "m"
    )


BEST = """best AS (SELECT c.SignalID, c.PrimaryName, c.SecondaryName, c.m, c."DB Id" AS LocationId, "Maintained By",
        "Custom Identifier", City, County, CASE WHEN split_part("Custom Identifier", ' ', 1) = c.SignalID THEN 1 ELSE 0 END AS good
    FROM close c JOIN locations l ON c."DB Id" = l."DB Id"
    QUALIFY row_number() OVER (PARTITION BY c."DB Id" ORDER BY good DESC, m, c.SignalID) = 1)"""
MATCH_COLUMNS = "SignalID,PrimaryName,SecondaryName,m,LocationId,Maintained By,Custom Identifier,City,County"


@register("g21_maintenance_match", MATCH_COLUMNS,
          "WITH " + NEAREST + ", " + BEST + "\n---\nSELECT * FROM best", "intersections locations")
def g21(t):
    return geo.maintenance_match(tv.intersections(t), tv.locations(t))


@register("e12_best_match_per_location", "LocationId,SignalID,m",
          "WITH " + NEAREST + ", " + BEST + "\n---\nSELECT * FROM best", "intersections locations")
def e12(t):
    return geo.maintenance_match(tv.intersections(t), tv.locations(t)).select("LocationId", "SignalID", "m")


@register("b09_located_rows", "c_custkey,Latitude:r,Longitude:r",
          """SELECT c_custkey, CAST(c_custkey % 9 AS DOUBLE) AS Latitude, CAST(c_custkey % 7 AS DOUBLE) AS Longitude FROM customer
             WHERE c_custkey % 9 <> 0 AND c_custkey % 7 <> 0""")
def b09(t):
    key = F.col("c_custkey")
    return filters.located(
        t.customer.select("c_custkey", (key % 9).cast("double").alias("Latitude"), (key % 7).cast("double").alias("Longitude"))
    )


COORDS = """SELECT p_partkey, p_brand, p_type,
    'LINE ''' || p_size || '.5 ' || (p_partkey % 90) || '.25, ' || (p_size + 1) || ' ' || (p_partkey % 60) || '''' AS coordinates FROM part"""


def coordinates():
    size, key = F.col("p_size"), F.col("p_partkey")
    return F.concat(
        F.lit("LINE '"), size, F.lit(".5 "), key % 90, F.lit(".25, "), size + 1, F.lit(" "), key % 60, F.lit("'")
    )


LINE = "'LINESTRING (' || p_size || '.5 ' || (p_partkey % 90) || '.25, ' || (p_size + 1) || '.0 ' || (p_partkey % 60) || '.0)'"


@register("s12_segment_points", "p_partkey,points,line", f"SELECT p_partkey, 2 AS points, {LINE} AS line FROM part")
def s12(t):
    points = fn.segment_points(coordinates())
    return t.part.select("p_partkey", F.size(points).alias("points"), fn.line_wkt(points).alias("line"))


@register("s13_distinct_geometry_points", "p_partkey,points,line",
          """SELECT p_partkey, CASE WHEN p_size % 5 = p_partkey % 5 THEN 1 ELSE 2 END AS points,
             'LINESTRING (' || (p_size % 5) || '.0 1.0' || CASE WHEN p_size % 5 = p_partkey % 5 THEN '' ELSE ', ' || (p_partkey % 5) || '.0 1.0' END || ')' AS line
             FROM part""")
def s13(t):
    a, b = F.concat(F.col("p_size") % 5, F.lit(" 1")), F.concat(F.col("p_partkey") % 5, F.lit(" 1"))
    points = fn.geometry_points(F.concat(a, F.lit(":"), b, F.lit(","), a))
    return t.part.select("p_partkey", F.size(points).alias("points"), fn.line_wkt(points).alias("line"))


@register("s14_points_to_line", "l_orderkey,geometry",
          """SELECT l_orderkey, 'LINESTRING (' || string_agg(CAST(l_quantity AS INTEGER) || '.0 ' || l_linenumber || '.0', ', '
               ORDER BY l_linenumber, l_quantity) || ')' AS geometry FROM lineitem GROUP BY l_orderkey""")
def s14(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_linenumber").cast("double").alias("lat"))
    return geo.points_to_line(rows, "l_quantity", "lat", "l_linenumber", "l_orderkey")


COLORS = """named AS (SELECT DISTINCT coalesce(Corridor, 'None') AS Corridor FROM corridors WHERE Zone LIKE 'Zone%'),
    pal AS (SELECT Corridor, ['#e41a1c', '#377eb8', '#4daf4a', '#984ea3', '#ff7f00', '#ffff33', '#a65628', '#f781bf'][(row_number() OVER (ORDER BY Corridor) - 1) % 8 + 1] AS color FROM named),
    colors AS (SELECT * FROM pal WHERE Corridor <> 'None' UNION ALL SELECT 'None', '#D0D0D0')"""


@register("e14_corridor_palette", "Corridor,color", "WITH " + COLORS + "\n---\nSELECT * FROM colors", "corridors")
def e14(t):
    return geo.corridor_colors(tv.corridors(t))


def segment_rows(t):
    """Segments named after nations; some brands stand for no corridor."""
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    name = F.when(brand % 4 == 0, F.lit(None)).when(brand % 4 == 1, F.lit("Elsewhere")).otherwise(
        F.concat(F.lit("NATION_"), brand)
    )
    coords = F.when(F.col("p_partkey") % 10 != 0, coordinates()).otherwise(F.lit("no points"))
    return t.part.select(
        F.col("p_partkey").alias("tmc"), name.alias("Corridor"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("Subcorridor"), coords.alias("coordinates"),
    )


SEGMENTS = """b AS (SELECT *, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INTEGER) AS n FROM part),
    seg AS (SELECT p_partkey AS tmc, CASE WHEN n % 4 = 0 THEN 'None' WHEN n % 4 = 1 THEN 'Elsewhere' ELSE 'NATION_' || n END AS Corridor,
        CASE WHEN p_type <> 'PROMO' THEN p_type END AS Subcorridor, p_partkey % 10 <> 0 AS has_points, """ + LINE + """ AS geometry FROM b)"""


@register("c12_segments_with_colors", "tmc,Corridor,color",
          "WITH " + COLORS + ", " + SEGMENTS + "\n---\nSELECT tmc, s.Corridor, c.color FROM seg s LEFT JOIN colors c ON s.Corridor = c.Corridor",
          "corridors")
def c12(t):
    rows = segment_rows(t).select("tmc", F.coalesce("Corridor", F.lit("None")).alias("Corridor"))
    return checked_join(rows, geo.corridor_colors(tv.corridors(t)), ["Corridor"], "left").select("tmc", "Corridor", "color")


@register("g20_map_segment_layer", "tmc,Corridor,Subcorridor,color,geometry",
          "WITH " + COLORS + ", " + SEGMENTS + """
---
SELECT tmc, s.Corridor, Subcorridor, CASE WHEN s.Corridor <> 'None' AND color IS NULL THEN '#494949' ELSE color END AS color, geometry
FROM seg s LEFT JOIN colors c ON s.Corridor = c.Corridor WHERE has_points""", "corridors")
def g20(t):
    return geo.segment_layer(segment_rows(t), tv.corridors(t)).select("tmc", "Corridor", "Subcorridor", "color", "geometry")


@register("g20_map_subcorridor_layer", "tmc,Corridor,Subcorridor,color,geometry",
          "WITH " + COLORS + ", " + SEGMENTS + """
---
SELECT tmc, s.Corridor, Subcorridor, CASE WHEN s.Corridor <> 'None' AND color IS NULL THEN '#494949' ELSE color END AS color, geometry
FROM seg s LEFT JOIN colors c ON s.Corridor = c.Corridor WHERE has_points AND Subcorridor IS NOT NULL""", "corridors")
def g20b(t):
    corridors = tv.corridors(t).withColumn("Description", F.col("Name"))
    layers = geo.map_layers(segment_rows(t), tv.intersections(t), corridors)
    return layers["subcorridors"].select("tmc", "Corridor", "Subcorridor", "color", "geometry")


def signal_places(t):
    """Corridors with colours, as the map knows them; some regions stand outside the zones."""
    colors = geo.corridor_colors(tv.corridors(t))
    place = checked_join(tv.corridors(t), colors, ["Corridor"], "left")
    zone = F.when(F.col("Zone_Group") == "ASIA", F.lit("Outside")).otherwise(F.col("Zone"))
    text = F.when(F.col("SignalID") % 2 == 0, F.concat(F.lit("Known "), F.col("SignalID")))
    return place.select("SignalID", zone.alias("Zone"), "Corridor", text.alias("Description"), "color")


PLACES = """pl AS (SELECT CAST(SignalID AS VARCHAR) AS SignalID, CASE WHEN Zone_Group = 'ASIA' THEN 'Outside' ELSE Zone END AS Zone,
        k.Corridor, CASE WHEN SignalID % 2 = 0 THEN 'Known ' || SignalID END AS Description, color
    FROM corridors k LEFT JOIN colors c ON k.Corridor = c.Corridor),
    sig AS (SELECT i.SignalID, PrimaryName, SecondaryName, Zone, coalesce(Corridor, 'None') AS Corridor, color,
        coalesce(Description, i.SignalID || ': ' || PrimaryName || ' @ ' || SecondaryName) AS Description
    FROM intersections i LEFT JOIN pl ON i.SignalID = pl.SignalID WHERE Latitude <> 0 AND Longitude <> 0)"""


@register("c11_signals_with_corridors", "SignalID,Zone,Corridor,Description",
          "WITH " + COLORS + ", " + PLACES + "\n---\nSELECT * FROM sig", "corridors intersections")
def c11(t):
    return geo.signal_layer(tv.intersections(t), signal_places(t)).select("SignalID", "Zone", "Corridor", "Description")


STYLED = "WITH " + COLORS + ", " + PLACES + """
---
SELECT SignalID, Description, CASE WHEN Zone LIKE 'Z%' THEN '#000000' ELSE '#FFFFFF' END AS fill_color,
       CASE WHEN Zone LIKE 'Z%' THEN color WHEN Corridor = 'None' THEN '#D0D0D0' ELSE '#000000' END AS stroke_color FROM sig"""


@register("g20_map_signal_layer", "SignalID,Description,fill_color,stroke_color", STYLED, "corridors intersections")
def g20c(t):
    layer = geo.signal_layer(tv.intersections(t), signal_places(t))
    return layer.select("SignalID", "Description", "fill_color", "stroke_color")


@register("s16_conditional_colors", "SignalID,fill_color,stroke_color", STYLED, "corridors intersections")
def s16(t):
    layer = geo.signal_layer(tv.intersections(t), signal_places(t))
    return layer.select(
        "SignalID", fn.signal_fill("Zone").alias("fill_color"), fn.signal_stroke("Zone", "Corridor", "color").alias("stroke_color")
    )
