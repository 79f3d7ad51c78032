"""Row filters and small projections."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor_metrics.functions.columns import is_tue_wed_thu, naive
from corridor_metrics.operators.scale import checked_join

MAINLINE_PHASES = (2, 6)

# Zones of the two zone-group programmes.
RTOP1_ZONES = ["Zone 1", "Zone 2", "Zone 3", "Zone 8"]
RTOP2_ZONES = ["Zone 4", "Zone 5", "Zone 6", "Zone 7m", "Zone 7d"]
ZONE7 = ["Zone 7m", "Zone 7d"]


def of_signals(df: DataFrame, signals: Iterable | DataFrame | None, column: str = "SignalID") -> DataFrame:
    """Keep the listed signals; a DataFrame of signals becomes a semi join."""
    if signals is None:
        return df
    if isinstance(signals, DataFrame):
        return checked_join(df, signals.select(column).distinct(), [column], "left_semi")
    return df.where(F.col(column).isin(list(signals)))


def events_between(
    df: DataFrame,
    start: dt.date,
    end: dt.date,
    signals: Iterable | DataFrame | None = None,
    event_codes: Iterable[int] | None = None,
    twr_only: bool = False,
) -> DataFrame:
    """Raw events in ``[start, end + 1 day)``, optionally of some signals, codes, or Tue-Thu only."""
    stop = end + dt.timedelta(days=1)
    out = df.where((F.col("timestamp") >= naive(start)) & (F.col("timestamp") < naive(stop)))
    if event_codes is not None:
        out = out.where(F.col("eventcode").isin(list(event_codes)))
    if twr_only:
        out = out.where(is_tue_wed_thu("timestamp"))
    return of_signals(out, signals, "signalid")


def dates_between(
    df: DataFrame,
    start: dt.date,
    end: dt.date,
    signals: Iterable | DataFrame | None = None,
    twr_only: bool = True,
    date_col: str = "date",
    signal_col: str = "signalid",
) -> DataFrame:
    """Rows of the closed date range; on a partition column this prunes files."""
    out = df.where(F.col(date_col).between(F.lit(start), F.lit(end)))
    if twr_only:
        out = out.where(is_tue_wed_thu(date_col))
    return of_signals(out, signals, signal_col)


def day_gate(df: DataFrame, date_col: str, twr_only: bool) -> DataFrame:
    return df.where(is_tue_wed_thu(date_col)) if twr_only else df


def mainline(df: DataFrame, mainline_only: bool = True) -> DataFrame:
    return df.where(F.col("CallPhase").isin(*MAINLINE_PHASES)) if mainline_only else df


def with_timeperiod(df: DataFrame) -> DataFrame:
    """Name the first time column ``Timeperiod`` unless the frame has one."""
    if "Timeperiod" in df.columns:
        return df
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)]
    return df.withColumnRenamed(times[0], "Timeperiod") if times else df


# Column names of raw counts and of the report side.
REPORT_NAMES = {
    "signalid": "SignalID", "eventparam": "Detector", "timeperiod": "Timeperiod",
    "callphase": "CallPhase", "date": "Date",
}


def report_names(df: DataFrame) -> DataFrame:
    """Raw-event column names to report column names."""
    return df.select(*[F.col(c).alias(REPORT_NAMES.get(c.lower(), c)) for c in df.columns])


def peak_hours(df: DataFrame, hours: Sequence[int], column: str = "Date_Hour") -> DataFrame:
    return df.where(F.hour(column).isin(*hours))


def safety_speeds(df: DataFrame) -> DataFrame:
    """Free-flow speed rows of the safety index: 20 mph and more, hours 9-10 and 19-20."""
    hour = F.hour("Minute")
    return df.where(
        (F.col("speed") >= 20) & (hour.between(9, 10) | hour.between(19, 20))
    ).select("tmc_code", "Corridor", "Subcorridor", "Minute", "speed", hour.alias("hr"))


def real_signals(df: DataFrame) -> DataFrame:
    return df.where((F.col("SignalID") > 0) & F.col("Include"))


def marked_contracts(df: DataFrame) -> DataFrame:
    return df.where((F.col("Contract") == F.col("District")) | F.col("Contract").isin("RTOP1", "RTOP2"))


def located(df: DataFrame, need_longitude: bool = True) -> DataFrame:
    """Rows with usable coordinates."""
    out = df.where(F.col("Latitude") != 0)
    return out.where(F.col("Longitude") != 0) if need_longitude else out


def zone_set(zone_group: str) -> list[str]:
    """Names under which the rows of a zone group are filed."""
    return {
        "All RTOP": ["All RTOP", "RTOP1", "RTOP2", *RTOP1_ZONES, *RTOP2_ZONES],
        "RTOP1": ["All RTOP", "RTOP1", *RTOP1_ZONES],
        "RTOP2": ["All RTOP", "RTOP2", *RTOP2_ZONES],
        "Zone 7": ZONE7,
    }[zone_group]


def zone_group_predicate(level: str, zone_group: str, corridor: str | None) -> Column:
    if level in ("corridor", "subcorridor"):
        if "RTOP" in zone_group or zone_group == "Zone 7":
            return F.col("Zone_Group").isin(zone_set(zone_group))
        if corridor == "All Corridors":
            return F.col("Zone_Group") == zone_group
    return F.col("Corridor") == corridor


def before_today(df: DataFrame, today: dt.date, date_col: str = "date") -> DataFrame:
    """Leave out today's unfinished data."""
    return df.where(F.col(date_col) != F.lit(today))


def low_uptime(df: DataFrame, calcs_start: dt.date | None = None, threshold: float = 0.5) -> DataFrame:
    out = df.where(F.col("uptime") < threshold)
    return out if calcs_start is None else out.where(F.col("Date") >= F.lit(calcs_start))
