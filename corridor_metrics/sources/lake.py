"""Scans of the date-partitioned lake, files and listings."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corridor_metrics.functions.columns import all_to_utc, path_date, path_number
from corridor_metrics.functions.dates import Span
from corridor_metrics.operators.filters import dates_between, events_between, of_signals
from corridor_metrics.sources.versions import names_in

MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def without_internal_columns(df: DataFrame) -> DataFrame:
    """Columns in name order, without those that start with ``__``."""
    return df.select(*sorted(c for c in df.columns if not c.startswith("__")))


def read_object(
    spark: SparkSession, path: str, day: dt.date | None = None, empty: T.StructType | None = None
) -> DataFrame:
    """One Parquet file or folder with ``Date`` from ``day`` or from its path.

    A missing path gives no rows, with the columns of ``empty``.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in MISSING:
            raise
        return spark.createDataFrame([], empty or T.StructType([]))
    kept = without_internal_columns(df)
    if day is not None:
        return kept.withColumn("Date", F.lit(day))
    if not re.search(r"\d{4}-\d{2}-\d{2}", path):
        return kept
    return df.withColumn("Date", path_date("_metadata.file_path")).select(
        *[c for c in kept.columns if c != "Date"], "Date"
    )


def read_dates(
    spark: SparkSession, root: str, table: str, start: dt.date, end: dt.date,
    signals: Iterable | DataFrame | None = None, callback: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """A closed date range of a table partitioned by ``date``, in UTC, passed through ``callback``.

    The date condition prunes partitions; the signal list reaches the scan.
    """
    df = spark.read.parquet(f"{root}/{table}").where(F.col("date").between(F.lit(start), F.lit(end)))
    if signals is not None:
        df = of_signals(df, signals)
    df = df.withColumn("Date", F.col("date")) if "Date" not in df.columns else df.withColumnRenamed("date", "Date")
    return all_to_utc(without_internal_columns(df)).transform(callback)


def listed_dates(spark: SparkSession, path: str, column: str = "date") -> list[dt.date]:
    """Dates of the partitions below a folder, sorted, by the names of the folders alone; no data file is opened."""
    found = []
    for name in names_in(spark, path):
        key, _, value = name.partition("=")
        if key == column and re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
            found.append(dt.date.fromisoformat(value))
    return found


def events_of(spark: SparkSession, root: str, table: str, days: Sequence[Span]) -> DataFrame:
    """Events of the lake in some spans of dates; other partitions are pruned."""
    wanted = reduce(or_, [F.col("date").between(F.lit(first), F.lit(last)) for first, last in days], F.lit(False))
    return lower_names(spark.read.parquet(f"{root}/{table}").where(wanted))


def read_month(spark: SparkSession, root: str, table: str, month: dt.date) -> DataFrame:
    """All partitions of one month, as a date range so that the scan is pruned."""
    stop = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return spark.read.parquet(f"{root}/{table}").where(
        (F.col("date") >= F.lit(month.replace(day=1))) & (F.col("date") < F.lit(stop))
    )


def controller_events(
    spark: SparkSession, source: str, start: dt.date, end: dt.date, signals: Iterable | DataFrame | None = None,
    event_codes: Iterable[int] | None = None, twr_only: bool = False, jdbc: dict | None = None,
) -> DataFrame:
    """Raw events from a Parquet path, or from a database table when ``jdbc`` has the connection.

    The conditions are pushed down in both cases.
    """
    if jdbc:
        df = spark.read.format("jdbc").options(dbtable=source, **jdbc).load()
    else:
        df = spark.read.parquet(source)
    return events_between(lower_names(df), start, end, signals, event_codes, twr_only)


def lower_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(c.lower()) for c in df.columns])


def lake_events(
    spark: SparkSession, root: str, table: str, start: dt.date, end: dt.date,
    signals: Iterable | DataFrame | None = None, twr_only: bool = True,
) -> DataFrame:
    """Events of the lake by closed date range; Tue-Thu unless told otherwise."""
    return dates_between(spark.read.parquet(f"{root}/{table}"), start, end, signals, twr_only)


def cycle_data(spark, root, start, end, signals=None) -> DataFrame:
    return lake_events(spark, root, "CycleData", start, end, signals, twr_only=False)


def detection_events(spark, root, start, end, signals=None) -> DataFrame:
    return lake_events(spark, root, "DetectionEvents", start, end, signals, twr_only=False)


# Columns of the text sources.
CSV_SCHEMAS = {
    "ped_plans": "SignalID bigint, Detector bigint, CallPhase int",
    "intersections": "SignalID string, PrimaryName string, SecondaryName string, Latitude double, Longitude double",
    "serious_injury_pct": "mph_bin double, pct double",
    "readings": (
        "tmc_code string, measurement_tstamp timestamp_ntz, speed double, reference_speed double, "
        "travel_time_minutes double, confidence_score double"
    ),
}


def read_csv(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A text source with its declared columns; nothing is inferred from the data."""
    return spark.read.csv(path, header=True, schema=CSV_SCHEMAS[kind], enforceSchema=True)


def _steps(path: Column) -> Column:
    """Names along a path, without its scheme and host."""
    return F.filter(F.split(F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/"), lambda x: x != "")


def latest_feed(df: DataFrame, source: str) -> DataFrame:
    """Rows of the last feed of a source that is read with all its files.

    A feed is one file right below the folder ``source``, or one folder there with as many files
    as its writer made; the one whose name sorts last is the last one. ``source`` is an absolute path.
    """
    feed = F.element_at(_steps(F.col("_metadata.file_path")), F.size(_steps(F.lit(source))) + 1)
    feeds = df.select("*", feed.alias("_feed"))
    return feeds.where(F.col("_feed") == feeds.agg(F.max("_feed")).scalar()).drop("_feed")


def signals_in_paths(df: DataFrame, prefix: str) -> DataFrame:
    """Distinct (date, SignalID) that the file names of a table mention."""
    path = F.col("_metadata.file_path")
    return (
        df.select(path_date(path).alias("date"), path_number(path, prefix).alias("SignalID"))
        .where(F.col("SignalID").isNotNull())
        .distinct()
    )


def all_signals(per_date: DataFrame) -> DataFrame:
    return per_date.select("SignalID").distinct()


def freshness(df: DataFrame) -> DataFrame:
    """When the newest file of a table was written."""
    return df.agg(F.max("_metadata.file_modification_time").alias("last_modified"))


def manifest(spark: SparkSession, path: str, extensions: Sequence[str] | None = None) -> DataFrame:
    """Files below a path with extension, size and time; their content is not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "length", F.col("modificationTime").alias("last_modified"))
        .withColumn("extension", F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)))
    )
    return files if not extensions else files.where(F.col("extension").isin([e.lower() for e in extensions]))


def manifest_summary(files: DataFrame, wanted: Column) -> DataFrame:
    """Number of files, and how many of them meet a condition."""
    return files.agg(
        F.count("*").alias("total_files"),
        F.count_if(wanted).alias("successful"),
        F.count_if(~wanted).alias("failed"),
    )
