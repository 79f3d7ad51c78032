"""Column expressions: time parts, text, display formats and colours."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_ZONE = "America/New_York"

# Display colours.
BLACK = "#000000"
WHITE = "#FFFFFF"
GRAY = "#D0D0D0"
UNCOLOURED = "#494949"
PALETTE = [
    "#e41a1c", "#377eb8", "#4daf4a", "#984ea3",
    "#ff7f00", "#ffff33", "#a65628", "#f781bf",
]

# Axis format per data type.
TICK_FORMATS = {"integer": ",.0", "decimal": ".2f", "percent": ".0%", "currency": "$,.2f"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- time ---------------------------------------------------------------


def naive(value: dt.datetime | dt.date) -> Column:
    """Literal naive time; written as text, because a datetime literal depends on time zones."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast(T.TimestampNTZType())


def floor_minutes(ts: Column | str, minutes: int) -> Column:
    """Start of the ``minutes``-long slot; keeps TIMESTAMP_NTZ, whatever the session zone.

    ``minutes`` must divide the hour. ``date_trunc`` would turn the value into a
    zoned timestamp.
    """
    if 60 % minutes:
        raise ValueError("minutes must divide 60")
    ts = _col(ts)
    return ts - F.make_dt_interval(
        F.lit(0), F.lit(0), F.minute(ts) % minutes, F.date_part(F.lit("SECOND"), ts)
    )


# Accepted names of the counting units.
UNIT_MINUTES = {"hours": 60, "hour": 60, "1 hour": 60, "15min": 15, "15 min": 15}


def floor_to_unit(ts: Column | str, unit: str) -> Column:
    if unit not in UNIT_MINUTES:
        raise ValueError(f"no counting unit {unit!r}; there are {sorted(UNIT_MINUTES)}")
    return floor_minutes(ts, UNIT_MINUTES[unit])


def iso_week(d: Column | str) -> Column:
    return F.weekofyear(_col(d))


def dow_monday1(d: Column | str) -> Column:
    """Monday=1 … Sunday=7 (``dayofweek`` would start on Sunday)."""
    return F.weekday(_col(d)) + 1


def dow_monday0(d: Column | str) -> Column:
    return F.weekday(_col(d))


def is_tue_wed_thu(d: Column | str) -> Column:
    return F.weekday(_col(d)).isin(1, 2, 3)


def week_start(d: Column | str) -> Column:
    """Most recent Monday, as a date."""
    d = F.to_date(_col(d))
    return F.date_sub(d, F.weekday(d))


def recent_monday(ts: Column | str) -> Column:
    """Most recent Monday with the time of day kept."""
    ts = _col(ts)
    return ts - F.make_dt_interval(F.weekday(ts))


def month_start(d: Column | str) -> Column:
    return F.to_date(F.trunc(F.to_date(_col(d)), "month"))


def month_end(d: Column | str) -> Column:
    return F.last_day(F.to_date(_col(d)))


def naive_as_utc(ts: Column | str) -> Column:
    """Instant whose UTC reading is the naive value, whatever the session zone."""
    ts = _col(ts)
    return F.make_timestamp_ltz(
        F.year(ts), F.month(ts), F.day(ts), F.hour(ts), F.minute(ts), F.date_part(F.lit("SECOND"), ts), F.lit("UTC")
    )


def utc_as_naive(ts: Column | str) -> Column:
    """Naive UTC reading of an instant, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _col(ts).cast(T.TimestampNTZType()))


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Microseconds between two naive times; days always have 24 hours."""
    return F.unix_micros(naive_as_utc(end)) - F.unix_micros(naive_as_utc(start))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return micros_between(start, end) / F.lit(1e6)


def all_to_utc(df: DataFrame) -> DataFrame:
    """Label naive timestamps as UTC; zoned ones are instants already."""
    return df.select(
        *[
            naive_as_utc(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def utc_text_to_local(text: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC to naive local time."""
    return F.convert_timezone(
        F.lit("UTC"), F.lit(zone), F.to_timestamp_ntz(_col(text), F.lit("yyyy-MM-dd HH:mm:ss"))
    )


def http_date_to_local(text: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """``Tue, 02 Jan 2024 03:04:05 GMT`` to naive local time.

    The week-day name is redundant, and Spark does not parse it.
    """
    stamp = F.to_timestamp_ntz(F.substring(_col(text), 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), stamp)


def not_before(d: Column | str, floor_date: str = "2019-01-01") -> Column:
    return F.greatest(_col(d), F.lit(floor_date).cast("date"))


def calendar(df: DataFrame, start: Column, end: Column, name: str, step: str = "1 day") -> DataFrame:
    """One row per input row and calendar step between two date columns."""
    return df.withColumn(name, F.explode(F.sequence(start, end, F.expr(f"interval {step}"))))


# --- text ---------------------------------------------------------------


def path_date(path: Column | str) -> Column:
    """First ISO date inside a path, or NULL."""
    found = F.regexp_extract(_col(path), r"\d{4}-\d{2}-\d{2}", 0)
    return F.to_date(F.nullif(found, F.lit("")))


def path_number(path: Column | str, prefix: str) -> Column:
    """Number that follows ``prefix`` inside a path, or NULL."""
    found = F.regexp_extract(_col(path), prefix + r"(\d+)", 1)
    return F.nullif(found, F.lit("")).cast("long")


def crossing_name(main: Column | str, side: Column | str) -> Column:
    return F.concat(_col(main), F.lit(" @ "), _col(side))


def labelled(key: Column | str, text: Column | str) -> Column:
    """``123: text`` with a whole-number key."""
    return F.concat(_col(key).cast("string"), F.lit(": "), _col(text))


def alert_name(name: Column | str, corridor: Column | str) -> Column:
    """Ramp meters are not crossings, so their names use a dash."""
    name = _col(name)
    return F.when(_col(corridor) == "Ramp Meter", F.replace(name, F.lit("@"), F.lit("-"))).otherwise(name)


def lane_text(approach: Column | str, lane: Column | str) -> Column:
    suffix = F.concat(F.lit(" Lane "), _col(lane).cast("int").cast("string"))
    return F.trim(F.concat(F.coalesce(_col(approach), F.lit("")), F.coalesce(suffix, F.lit(""))))


def first_token(text: Column | str) -> Column:
    """First white-space separated token, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(text), r"^\s*(\S+)", 1), F.lit(""))


# --- display ------------------------------------------------------------


def as_int(x: Column | str) -> Column:
    """Whole number with thousands separators; cuts the fraction off."""
    return F.format_number(_col(x).cast("long"), 0)


def as_2dec(x: Column | str) -> Column:
    return F.format_string("%.2f", _col(x))


def as_pct(x: Column | str) -> Column:
    return F.format_string("%.1f%%", _col(x) * 100)


def as_currency(x: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(_col(x), 2))


# Formatter per data type.
FORMATTERS = {"integer": as_int, "decimal": as_2dec, "percent": as_pct, "currency": as_currency}


def data_format(x: Column | str, data_type: Column | str) -> Column:
    """Format ``x`` by the data type named in another column; NULL for unknown types."""
    out = F.lit(None).cast("string")
    for name, fmt in FORMATTERS.items():
        out = F.when(_col(data_type) == name, fmt(x)).otherwise(out)
    return out


def tick_format(data_type: Column | str) -> Column:
    out = F.lit(None).cast("string")
    for name, fmt in TICK_FORMATS.items():
        out = F.when(_col(data_type) == name, F.lit(fmt)).otherwise(out)
    return out


def delta_text(delta: Column | str) -> Column:
    """`` (+1.5%)`` or `` (-1.5%)``; a missing delta counts as 0."""
    delta = F.coalesce(_col(delta), F.lit(0.0))
    return F.concat(F.when(delta > 0, F.lit(" (+")).otherwise(F.lit(" (")), as_pct(delta), F.lit(")"))


def signal_fill(zone: Column | str) -> Column:
    return F.when(_col(zone).startswith("Z"), F.lit(BLACK)).otherwise(F.lit(WHITE))


def signal_stroke(zone: Column | str, corridor: Column | str, color: Column | str) -> Column:
    return (
        F.when(_col(zone).startswith("Z"), _col(color))
        .when(_col(corridor) == "None", F.lit(GRAY))
        .otherwise(F.lit(BLACK))
    )


def segment_color(corridor: Column | str, color: Column | str) -> Column:
    return F.when((_col(corridor) != "None") & _col(color).isNull(), F.lit(UNCOLOURED)).otherwise(_col(color))


def highlight(corridor: Column | str, chosen: str, color: str) -> Column:
    return F.when(_col(corridor) == chosen, F.lit(color)).otherwise(F.lit("lightgray"))


# --- shapes -------------------------------------------------------------


def _points(parts: Column) -> Column:
    def point(text: Column) -> Column:
        xy = F.split(F.trim(text), r"\s+")
        return F.struct(
            F.element_at(xy, 1).cast("double").alias("lon"), F.element_at(xy, 2).cast("double").alias("lat")
        )

    return F.transform(parts, point)


def segment_points(text: Column | str) -> Column:
    """Points of the first quoted ``'lon lat, lon lat'`` list; empty when there is no quote."""
    quoted = F.nullif(F.regexp_extract(_col(text), "'(.*?)'", 1), F.lit(""))
    return F.when(quoted.isNotNull(), _points(F.split(quoted, ","))).otherwise(_points(F.array().cast("array<string>")))


def geometry_points(text: Column | str) -> Column:
    """Distinct points of a ``,`` or ``:`` separated list; empty for NULL."""
    parts = F.array_distinct(F.split(_col(text), "[,:]"))
    return F.when(_col(text).isNotNull(), _points(parts)).otherwise(_points(F.array().cast("array<string>")))


def line_wkt(points: Column | str) -> Column:
    """WKT of an array of lon/lat points; NULL when it is empty."""
    points = _col(points)
    text = F.array_join(
        F.transform(points, lambda p: F.concat(p["lon"].cast("string"), F.lit(" "), p["lat"].cast("string"))), ", "
    )
    return F.when(F.size(points) > 0, F.concat(F.lit("LINESTRING ("), text, F.lit(")")))
