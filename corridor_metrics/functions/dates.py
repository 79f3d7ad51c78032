"""Dates that are settled on the driver before a plan is built."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Span = tuple[dt.date, dt.date]  # first and last day
DAY = dt.timedelta(days=1)


def month_span(start: dt.date, end: dt.date) -> list[str]:
    """``YYYY-MM`` of every month from ``start`` to ``end``."""
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


def add_months(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away from the month of ``day``."""
    m = day.year * 12 + day.month - 1 + months
    return dt.date(m // 12, m % 12 + 1, 1)


def report_months(today: dt.date) -> list[dt.date]:
    """Thirteen month starts; the last one is the month of six days ago."""
    last = (today - dt.timedelta(days=6)).replace(day=1)
    return [add_months(last, i) for i in range(-12, 1)]


def joined_spans(spans: Iterable[Span]) -> list[Span]:
    """The same days as sorted spans with a gap between any two."""
    out: list[Span] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + DAY:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def spans_of(days: Iterable[dt.date]) -> list[Span]:
    return joined_spans((day, day) for day in days)


def without_spans(spans: Iterable[Span], others: Sequence[Span]) -> list[Span]:
    """The days of ``spans`` that are in none of the others."""
    out = joined_spans(spans)
    for first, last in joined_spans(others):
        pieces = []
        for a, b in out:
            if last < a or first > b:
                pieces.append((a, b))
                continue
            pieces += [(a, first - DAY)] * (a < first) + [(last + DAY, b)] * (last < b)
        out = pieces
    return out


def first_missing(days: Iterable[dt.date], today: dt.date) -> dt.date:
    """Day after the newest of some days, but never later than yesterday."""
    yesterday = today - DAY
    newest = max(days, default=None)
    return yesterday if newest is None else min(newest + DAY, yesterday)


def first_missing_date(table: DataFrame, today: dt.date, date_col: str = "date") -> dt.date:
    """``first_missing`` of the dates in the rows of a table; of a stored table, ``listed_dates`` gives them without a read."""
    newest = table.agg(F.max(F.to_date(F.col(date_col))).alias("d")).first()["d"]
    return first_missing([] if newest is None else [newest], today)


def resolve_date(
    text: str, today: dt.date, table: DataFrame | Iterable[dt.date] | None = None, literal_plus_one: bool = False
) -> dt.date | None:
    """``yesterday``, ``N days ago``, ``first_missing`` or a literal date.

    ``table`` is a frame with dates, or the dates themselves. ``literal_plus_one`` moves a literal date one day
    on, as some callers expect.
    """
    if text == "yesterday":
        return today - DAY
    ago = re.search(r"(\d+) days ago", text)
    if ago:
        return today - dt.timedelta(days=int(ago.group(1)))
    if text == "first_missing":
        if table is None:
            return None
        return first_missing_date(table, today) if isinstance(table, DataFrame) else first_missing(table, today)
    day = dt.date.fromisoformat(text[:10])
    return day + DAY if literal_plus_one else day
