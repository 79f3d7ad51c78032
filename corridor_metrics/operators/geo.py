"""Nearest locations, lines and map layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.functions.columns import (
    GRAY, PALETTE, first_token, labelled, crossing_name, line_wkt, segment_color, segment_points, signal_fill,
    signal_stroke,
)
from corridor_metrics.operators.dims import latest_by
from corridor_metrics.operators.filters import located
from corridor_metrics.operators.scale import checked_join, row_numbers

METRES_PER_DEGREE = 111139
RADIUS_M = 100
FAN = 8
LEVELS = 2
NEIGHBOURS = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]


def _degrees(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Planar distance in degrees."""
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def _cell(c: str, level: int, cell: float) -> Column:
    """Grid index at a level; coarser indexes are derived from the finest one, so they nest."""
    finest = F.floor(F.col(c) / F.lit(cell / FAN**LEVELS))
    return F.floor(finest / F.lit(FAN ** (LEVELS - level)))


def _pyramid(points: DataFrame, side: str, cell: float) -> list[DataFrame]:
    """Occupied cells of every level with their number of points and their parent cells, the coarsest level first.

    Points are counted once, in the finest cells; coarser cells add up the finer ones.
    """
    x, y, n = f"{side}x", f"{side}y", f"{side}n"
    parent = {f"{side}px": F.floor(F.col(x) / FAN), f"{side}py": F.floor(F.col(y) / FAN)}
    levels = [points.groupBy(_cell("x", LEVELS, cell).alias(x), _cell("y", LEVELS, cell).alias(y)).agg(F.count("*").alias(n)).withColumns(parent)]
    for _ in range(LEVELS):
        finer = levels[0].groupBy(F.col(f"{side}px").alias(x), F.col(f"{side}py").alias(y)).agg(F.sum(n).alias(n))
        levels.insert(0, finer.withColumns(parent))
    return levels


def _neighbour_cells(signals: DataFrame, locations: DataFrame) -> DataFrame:
    """Occupied location cells next to each occupied signal cell."""
    near = F.array(*[F.struct((F.col("sx") + dx).alias("lx"), (F.col("sy") + dy).alias("ly")) for dx, dy in NEIGHBOURS])
    around = signals.select("sx", "sy", "sn", F.inline(near))
    return around.join(locations.select("lx", "ly", "ln"), ["lx", "ly"])


def _bounds() -> tuple[Column, Column]:
    """Squares of the smallest and largest distance between points of a signal and a location cell, in cell widths."""
    gap = [F.abs(F.col("sx") - F.col("lx")), F.abs(F.col("sy") - F.col("ly"))]
    low = sum((F.pow(F.greatest(g - 1, F.lit(0)), F.lit(2)) for g in gap), F.lit(0.0))
    high = sum((F.pow(g + 1, F.lit(2)) for g in gap), F.lit(0.0))
    return low, high


def _refined_cells(near: DataFrame, signals: list[DataFrame], locations: list[DataFrame]) -> DataFrame:
    """Candidate cell pairs on the finest grid, split and pruned level by level down both pyramids.

    Location cells that cannot hold the nearest point of a signal cell are dropped: a cell is useless when even
    its nearest corner is farther than the farthest corner of another cell of the same signal cell. Split pairs
    are neither sorted nor stored: they are formed once for the smallest bound of each signal cell, a hash
    aggregate, and again to be compared with it. Both times read one shuffle of the location cells around a parent cell.
    """
    low, high = _bounds()
    useful = low <= F.col("_best") + F.lit(1e-6)
    # nine cells around a cell at most
    pairs = near.withColumn("_best", F.min(high).over(Window.partitionBy("sx", "sy"))).where(useful).select("sx", "sy", "lx", "ly")
    for level in range(1, LEVELS + 1):
        parents = pairs.toDF("spx", "spy", "lpx", "lpy")
        around = parents.join(locations[level], ["lpx", "lpy"]).select("spx", "spy", "lx", "ly")
        split = around.join(signals[level].select("spx", "spy", "sx", "sy"), ["spx", "spy"])
        best = split.groupBy("spx", "spy", "sx", "sy").agg(F.min(high).alias("_best"))
        pairs = around.join(best, ["spx", "spy"]).where(useful).select("sx", "sy", "lx", "ly")
    return pairs


def nearest_location(
    signals: DataFrame, locations: DataFrame, radius_m: float = RADIUS_M, pairs_per_point: int = 256
) -> DataFrame:
    """The closest location of each signal, if it is nearer than the radius.

    ``signals`` has SignalID, Longitude, Latitude, ``locations`` has ``DB Id`` and the
    same coordinates; distances are planar degrees. Equal distances go to the
    smallest ``DB Id``. ``m`` is the distance in whole metres.

    Points meet through the cells of a grid as wide as the radius. Copies of a
    coordinate count once. Where a cell and its neighbours are so full that pairing
    their points would take more than ``pairs_per_point`` pairs a point, the pairs of
    cells are first split and pruned down to cells of a ``FAN ** LEVELS``-th of the radius. This is
    decided for each cell inside the plan.
    """
    cell = radius_m / METRES_PER_DEGREE
    spots = signals.where(F.col("Longitude").isNotNull() & F.col("Latitude").isNotNull())
    sig = spots.select(F.col("Longitude").alias("x"), F.col("Latitude").alias("y")).distinct()
    loc = (
        locations.where(F.col("Longitude").isNotNull() & F.col("Latitude").isNotNull())
        .groupBy(F.col("Longitude").alias("x"), F.col("Latitude").alias("y"))
        .agg(F.min("DB Id").alias("DB Id"))
    )
    around = F.sum("ln").over(Window.partitionBy("sx", "sy"))
    crowded = F.col("sn") * around > pairs_per_point * (F.col("sn") + around)
    sig_cells, loc_cells = _pyramid(sig, "s", cell), _pyramid(loc, "l", cell)
    near = _neighbour_cells(sig_cells[0], loc_cells[0]).withColumn("_crowded", crowded)

    def placed(points: DataFrame, side: str, level: int) -> DataFrame:
        return points.withColumns(
            {f"{side}x": _cell("x", level, cell), f"{side}y": _cell("y", level, cell)}
        ).withColumnsRenamed({"x": f"{side}lon", "y": f"{side}lat"})

    def meet(pairs: DataFrame, level: int) -> DataFrame:
        """The nearest places of the signals in some cells, several where distances are equal.

        Pairs of points are formed twice, like pairs of cells: for the smallest distance, and to find who has it.
        """
        cells = pairs.select("sx", "sy", "lx", "ly")
        around = cells.join(placed(loc, "l", level), ["lx", "ly"]).select("sx", "sy", "llon", "llat")
        distance = _degrees(F.col("slon"), F.col("slat"), F.col("llon"), F.col("llat"))
        met = around.join(placed(sig, "s", level), ["sx", "sy"])
        least = met.groupBy("sx", "sy", "slon", "slat").agg(F.min(distance).alias("_d"))
        least = least.where(F.col("_d") * METRES_PER_DEGREE < radius_m)
        return around.join(least, ["sx", "sy"]).where(distance == F.col("_d")).select("slon", "slat", "llon", "llat", "_d")

    refined = _refined_cells(near.where("_crowded"), sig_cells, loc_cells)
    nearest = meet(near.where(~F.col("_crowded")), 0).unionByName(meet(refined, LEVELS))
    named = nearest.join(loc.withColumnsRenamed({"x": "llon", "y": "llat"}), ["llon", "llat"])
    smallest = F.when(F.count("*") == F.count("DB Id"), F.min("DB Id")).alias("DB Id")  # NULL is the smallest
    close = named.groupBy(F.col("slon").alias("Longitude"), F.col("slat").alias("Latitude"), "_d").agg(smallest)
    close = close.withColumn("_m", F.col("_d") * METRES_PER_DEGREE).drop("_d")
    return checked_join(spots, close, ["Longitude", "Latitude"]).withColumn("m", F.floor("_m").cast("int")).drop("_m")


def maintenance_match(signals: DataFrame, locations: DataFrame) -> DataFrame:
    """One signal per maintenance location: a matching identifier wins, then the nearest."""
    here = located(signals, need_longitude=False).withColumn("SignalID", F.col("SignalID").cast("string"))
    matched = nearest_location(here, locations.select("DB Id", "Longitude", "Latitude")).select(
        "SignalID", "PrimaryName", "SecondaryName", "m", "DB Id"
    )
    details = locations.select("DB Id", "Maintained By", "Custom Identifier", "City", "County")
    guessed = checked_join(matched, details, ["DB Id"]).withColumn(
        "good_guess", F.coalesce((first_token("Custom Identifier") == F.col("SignalID")).cast("int"), F.lit(0))
    )
    return latest_by(guessed, ["DB Id"], F.desc("good_guess"), F.asc("m"), F.asc("SignalID")).select(
        "SignalID", "PrimaryName", "SecondaryName", "m", F.col("DB Id").alias("LocationId"),
        "Maintained By", "Custom Identifier", "City", "County",
    )


def points_to_line(df: DataFrame, lon: str, lat: str, sort: str, id_field: str | None = None) -> DataFrame:
    """Ordered points to one line per id, or to a single line.

    A line is one value, so its points meet in one row by definition.
    """
    keys = [id_field] if id_field else []
    rows = df.dropna(subset=keys) if keys else df
    points = F.array_sort(F.collect_list(F.struct(F.col(sort).alias("o"), F.col(lon).alias("lon"), F.col(lat).alias("lat"))))
    return rows.groupBy(*keys).agg(points.alias("_p")).select(*keys, line_wkt("_p").alias("geometry"))


def corridor_colors(corridors: DataFrame) -> DataFrame:
    """A palette colour per corridor of the numbered zones, in name order, plus grey for none."""
    named = corridors.where(F.col("Zone").startswith("Zone")).select(F.coalesce("Corridor", F.lit("None")).alias("Corridor"))
    palette = F.array(*[F.lit(c) for c in PALETTE])
    colors = row_numbers(named.distinct(), "Corridor", "_n").select(
        "Corridor", F.element_at(palette, ((F.col("_n") - 1) % len(PALETTE) + 1).cast("int")).alias("color")
    )
    grey = corridors.sparkSession.range(1).select(F.lit("None").alias("Corridor"), F.lit(GRAY).alias("color"))
    return colors.where(F.col("Corridor") != "None").unionByName(grey)


def segment_layer(segments: DataFrame, corridors: DataFrame) -> DataFrame:
    """Coloured road segments with their line; segments without points are left out."""
    rows = segments.withColumn("Corridor", F.coalesce("Corridor", F.lit("None")))
    coloured = checked_join(rows, corridor_colors(corridors), ["Corridor"], "left")
    return (
        coloured.withColumn("color", segment_color("Corridor", "color"))
        .withColumn("geometry", line_wkt(segment_points("coordinates")))
        .where(F.col("geometry").isNotNull())
    )


def signal_layer(intersections: DataFrame, corridors: DataFrame) -> DataFrame:
    """Located signals with description and marker colours.

    ``corridors`` has SignalID, Zone, Corridor, Description and color.
    """
    rows = located(intersections).withColumn("SignalID", F.col("SignalID").cast("string"))
    place = corridors.withColumn("SignalID", F.col("SignalID").cast("string"))
    text = labelled("SignalID", crossing_name("PrimaryName", "SecondaryName"))
    return (
        checked_join(rows, place, ["SignalID"], "left")
        .withColumn("Corridor", F.coalesce("Corridor", F.lit("None")))
        .withColumn("Description", F.coalesce("Description", text))
        .withColumn("fill_color", signal_fill("Zone"))
        .withColumn("stroke_color", signal_stroke("Zone", "Corridor", "color"))
    )


def map_layers(segments: DataFrame, intersections: DataFrame, corridors: DataFrame) -> dict[str, DataFrame]:
    """Segment, subcorridor and signal layers; signals share the colour of their corridor."""
    lines = segment_layer(segments, corridors)
    coloured = checked_join(corridors, corridor_colors(corridors), ["Corridor"], "left")
    return {
        "corridors": lines,
        "subcorridors": lines.where(F.col("Subcorridor").isNotNull()),
        "signals": signal_layer(intersections, coloured),
    }
