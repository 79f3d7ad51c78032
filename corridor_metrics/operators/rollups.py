"""Signal to corridor to zone roll-ups by period, with period-over-period change."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.functions.columns import month_start, week_start
from corridor_metrics.functions.measures import drop_null_keys, relative_change, total, weighted_mean
from corridor_metrics.operators.filters import ZONE7, peak_hours
from corridor_metrics.operators.scale import checked_join, lag_in_blocks, lag_over_frame

CORRIDOR_KEYS = ["Zone_Group", "Zone", "Corridor"]


def with_delta(
    df: DataFrame, entity: Sequence[str], period: str, value: str, lag_scope: str = "entity"
) -> DataFrame:
    """Add ``delta``, the relative change to the preceding row.

    ``entity``: the row before of the same entity; the input is aggregated, so an
    entity has one row per calendar period. ``frame``: the row before in the sorted
    frame, which for an entity's first period belongs to another entity.
    """
    if lag_scope == "frame":
        lagged = lag_over_frame(df, [*entity, period], value, "lag_")
    elif lag_scope == "entity":
        lagged = df.withColumn("lag_", F.lag(value).over(Window.partitionBy(*entity).orderBy(period)))
    else:
        raise ValueError("lag_scope must be 'entity' or 'frame'")
    return lagged.withColumn("delta", relative_change(F.col(value), F.col("lag_"))).drop("lag_")


def in_corridors(df: DataFrame, corridors: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of signals that belong to a corridor, with the wanted corridor columns."""
    dim = corridors.where(F.col("Corridor").isNotNull()).select("SignalID", *columns)
    return checked_join(df, dim, ["SignalID"])


def weighted_mean_by_corridor(
    df: DataFrame, per: str, corridors: DataFrame, value: str, weight: str | None = None, lag_scope: str = "entity"
) -> DataFrame:
    """Mean, or weighted mean, of a signal metric by zone group, zone, corridor and period."""
    keys = [*CORRIDOR_KEYS, per]
    rows = drop_null_keys(in_corridors(df, corridors, CORRIDOR_KEYS), *keys)
    aggs = [F.avg(value).alias(value)] if weight is None else weighted_mean(value, weight)
    out = with_delta(rows.groupBy(*keys).agg(*aggs), CORRIDOR_KEYS, per, value, lag_scope)
    return out.select(*keys, value, *([weight] if weight else []), "delta")


def corridor_group(df: DataFrame, per: str, value: str, weight: str, label: str) -> DataFrame:
    """One labelled corridor group by period."""
    grouped = drop_null_keys(df, per).groupBy(per).agg(*weighted_mean(value, weight))
    named = grouped.withColumns({"Corridor": F.lit(label), "Zone_Group": F.lit(label)})
    return with_delta(named, ["Corridor"], per, value).select("Zone_Group", "Corridor", per, value, weight, "delta")


def zone_group_labels() -> Column:
    """All groups that a corridor row counts in: its zone and the super-groups."""
    group, zone = F.col("Zone_Group"), F.col("Zone")
    return F.array_compact(
        F.array(
            zone,
            F.when(group.isin("RTOP1", "RTOP2"), F.lit("All RTOP")),
            F.when(group.isin("RTOP1", "RTOP2"), group),
            F.when(zone.isin(*ZONE7), F.lit("Zone 7")),
        )
    )


def zone_roll_up(df: DataFrame, per: str, value: str, weight: str) -> DataFrame:
    """Every zone and the overlapping groups All RTOP, RTOP1, RTOP2, Zone 7, in one pass."""
    rows = df.withColumn("_group", F.explode(zone_group_labels()))
    grouped = (
        drop_null_keys(rows, per)
        .groupBy(F.col("_group").alias("Zone_Group"), F.col("_group").alias("Corridor"), per)
        .agg(*weighted_mean(value, weight))
    )
    return with_delta(grouped, ["Zone_Group", "Corridor"], per, value)


def corridor_groups(
    df: DataFrame, per: str, value: str, weight: str, groups: Callable[..., DataFrame] = zone_roll_up
) -> DataFrame:
    """Corridor rows followed by the rows of their groups, without duplicates.

    ``groups`` may be replaced by any function of the same signature.
    """
    own = df.select("Corridor", "Zone", per, value, weight, "delta")
    return own.unionByName(groups(df, per, value, weight), allowMissingColumns=True).distinct()


def hourly_by_signal(df: DataFrame, value: str, corridors: DataFrame, lag_scope: str = "entity") -> DataFrame:
    """Hourly signal rows with their corridor and the change to the hour before."""
    place = ["Zone_Group", "Zone", "Corridor", "Subcorridor"]
    rows = in_corridors(df, corridors, place)
    if lag_scope == "frame":
        lagged = lag_over_frame(rows, ["SignalID", "Corridor", "Hour"], value, "lag_")
    else:
        days = rows.withColumn("_day", F.to_date("Hour"))
        lagged = lag_in_blocks(days, ["SignalID", "Corridor"], "_day", "Hour", value, "lag_")
    return lagged.withColumn("delta", relative_change(F.col(value), F.col("lag_"))).select(
        "SignalID", "Hour", value, "delta", *place
    )


def _weighted_by(df: DataFrame, entity: str, per: str, value: str, weight: str, lag_scope: str) -> DataFrame:
    rows = df.withColumn(weight, F.lit(1)) if weight == "ones" else df
    grouped = drop_null_keys(rows, entity, per).groupBy(entity, per).agg(*weighted_mean(value, weight))
    return with_delta(grouped, [entity], per, value, lag_scope).select(entity, per, value, weight, "delta")


def period_avg(df: DataFrame, value: str, per: str, weight: str = "ones", lag_scope: str = "entity") -> DataFrame:
    """Weighted mean by signal and period; the weight ``ones`` counts rows."""
    return _weighted_by(df, "SignalID", per, value, weight, lag_scope)


def period_sum(df: DataFrame, value: str, per: str, lag_scope: str = "entity") -> DataFrame:
    grouped = drop_null_keys(df, "SignalID", per).groupBy("SignalID", per).agg(total(value).alias(value))
    return with_delta(grouped, ["SignalID"], per, value, lag_scope).select("SignalID", per, value, "delta")


def daily_avg(
    df: DataFrame, value: str, weight: str = "ones", peak_only: bool = False, hours: Sequence[int] = (),
    lag_scope: str = "entity",
) -> DataFrame:
    """Daily weighted mean by signal, optionally over the peak hours of ``Date_Hour``."""
    rows = peak_hours(df, hours) if peak_only else df
    return _weighted_by(rows, "SignalID", "Date", value, weight, lag_scope)


def daily_avg_camera(df: DataFrame, value: str = "uptime", weight: str = "num", lag_scope: str = "entity") -> DataFrame:
    return _weighted_by(df, "CameraID", "Date", value, weight, lag_scope)


# --- day to week and month ------------------------------------------------


# Period column and its first day, per report resolution.
PERIODS = {"dy": ("Date", None), "wk": ("Week", week_start), "mo": ("Month", month_start)}


def with_period(df: DataFrame, resolution: str) -> tuple[DataFrame, str]:
    """Add the period column of a resolution (``dy``, ``wk``, ``mo``) and name it."""
    name, start = PERIODS[resolution]
    return (df if start is None else df.withColumn(name, start("Date"))), name


def signal_uptime(daily: DataFrame, resolution: str, value: str = "uptime") -> DataFrame:
    """Weekly or monthly mean of a daily signal metric."""
    rows, per = with_period(daily, resolution)
    return period_avg(rows, value, per)


def corridor_uptime(df: DataFrame, corridors: DataFrame, resolution: str, value: str = "uptime") -> DataFrame:
    """Corridor mean of a signal metric that carries ``Date`` or the period column itself."""
    name = PERIODS[resolution][0]
    rows, per = (df, name) if name in df.columns else with_period(df, resolution)
    return weighted_mean_by_corridor(rows.withColumn("ones", F.lit(1)), per, corridors, value, "ones")


def period_avg_by_day(
    df: DataFrame, value: str, resolution: str, weight: str = "ones", peak_only: bool = False, hours: Sequence[int] = ()
) -> DataFrame:
    """Mean of the daily means of each signal over a week or month."""
    rows, per = with_period(daily_avg(df, value, weight, peak_only, hours).drop("delta"), resolution)
    return period_avg(rows, value, per, weight)


def corridor_avg_by_day(df: DataFrame, corridors: DataFrame, value: str, per: str, weight: str = "ones") -> DataFrame:
    return weighted_mean_by_corridor(df, per, corridors, value, weight)


def subcorridors_of(corridors: DataFrame) -> DataFrame:
    """The corridor table one level down: subcorridors take the place of corridors."""
    return corridors.where(F.col("Subcorridor").isNotNull()).select(
        "SignalID",
        F.col("Zone").alias("Zone_Group"),
        F.col("Corridor").alias("Zone"),
        F.col("Subcorridor").alias("Corridor"),
    )
