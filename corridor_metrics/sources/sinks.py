"""Date- and month-partitioned writes, marts and database appends."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor_metrics.operators.marts import mart_name

TEXT_KEYS = ("Detector", "CallPhase", "SignalID")


def _dynamic(df: DataFrame):
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def text_keys(df: DataFrame) -> DataFrame:
    """Keys are stored as text, whatever type a run computed them in."""
    return df.withColumns({c: F.col(c).cast("string") for c in TEXT_KEYS if c in df.columns})


def write_date(df: DataFrame, root: str, table: str, day: dt.date, catalog_table: str | None = None) -> None:
    """Replace one date partition, also by no rows, and register it when the table is in the catalog."""
    rows = text_keys(df.drop("Date", "date"))
    rows.write.mode("overwrite").parquet(f"{root}/{table}/date={day}")
    if catalog_table:
        from corridor_metrics.sources.catalog import add_date_partition

        add_date_partition(df.sparkSession, catalog_table, day)


def with_date(df: DataFrame) -> DataFrame:
    """``Date`` from ``Timeperiod`` or ``Hour`` where it is missing."""
    if "Date" in df.columns:
        return df
    source = next(c for c in ("Timeperiod", "Hour") if c in df.columns)
    return df.withColumn("Date", F.to_date(source))


def write_by_date(df: DataFrame, root: str, table: str) -> None:
    """Replace every date partition that occurs in the rows.

    Rebalancing gathers a date in few files and splits a date that is too large.
    """
    rows = text_keys(with_date(df)).withColumnRenamed("Date", "date")
    _dynamic(rows.hint("rebalance", "date")).partitionBy("date").parquet(f"{root}/{table}")


def write_by_month(df: DataFrame, root: str, table: str, date: Column | str = "Date") -> None:
    """Replace the month partitions that occur in the rows."""
    col = F.col(date) if isinstance(date, str) else date
    rows = df.withColumn("month", F.trunc(F.to_date(col), "month"))
    _dynamic(rows.hint("rebalance", "month")).partitionBy("month").parquet(f"{root}/{table}")


# The column that a stored mart is read by, per period.
PERIOD_COLUMNS = {"dy": "Date", "wk": "Date", "mo": "Month", "qu": "Quarter"}


def first_period(period: str, start: dt.date) -> dt.date | float:
    """The day, Monday, month or quarter that holds the first calculated date."""
    if period == "wk":
        return start - dt.timedelta(days=start.weekday())
    if period == "mo":
        return start.replace(day=1)
    if period == "qu":
        return start.year + (start.month + 2) // 3 / 10
    return start


def mart_rows(df: DataFrame, period: str, calcs_start: dt.date | None = None) -> DataFrame:
    """A mart as it is stored; periods before that of the first calculated date are left out.

    Weekly marts are stored with the Monday as ``Date``. Hourly rows are cut by ``Hour``.
    """
    if period == "wk" and "Date" not in df.columns:
        df = df.withColumnRenamed("Week", "Date")
    if calcs_start is None:
        return df
    column = next(c for c in ("Hour", PERIOD_COLUMNS[period], "Date") if c in df.columns)
    return df.where(F.col(column) >= F.lit(first_period(period, calcs_start)))


def save_mart(df: DataFrame, root: str, level: str, period: str, metric: str, calcs_start: dt.date | None = None) -> str:
    """Write one mart, which then holds ``mart_rows``. Returns its path."""
    path = f"{root}/{mart_name(level, period, metric)}"
    mart_rows(df, period, calcs_start).write.mode("overwrite").parquet(path)
    return path


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace a whole output, such as the alerts of a day."""
    df.write.mode("overwrite").parquet(path)


def append_to_database(df: DataFrame, url: str, table: str, chunk: int = 10_000, **options: str) -> None:
    """Append rows to a relational table, ``chunk`` rows per statement; NULLs and quotes are bound values."""
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", chunk)
        .options(**options)
        .mode("append")
        .save()
    )


def read_back(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}")
