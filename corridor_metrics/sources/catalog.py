"""Partition upkeep of catalog tables.

Partitions are named by the period they hold; there is no open-ended one, because
a write creates the partitions it needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corridor_metrics.functions.dates import add_months
from corridor_metrics.sources.lake import listed_dates

MONTHS_BACK = 10
MONTHS_TO_KEEP = 8


def create_mart_table(
    spark: SparkSession, table: str, location: str, today: dt.date, period_field: str = "Timeperiod"
) -> None:
    """A mart table with month partitions from ten months ago to next month."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} (
            Zone_Group STRING, Corridor STRING, `{period_field}` TIMESTAMP_NTZ, var DOUBLE,
            ones DOUBLE, delta DOUBLE, Description STRING, month DATE)
        USING parquet PARTITIONED BY (month) LOCATION '{location}'"""
    )
    for offset in range(-MONTHS_BACK, 2):
        add_month_partition(spark, table, add_months(today, offset))


def add_month_partition(spark: SparkSession, table: str, month: dt.date) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (month = DATE'{month.replace(day=1)}')")


def add_next_month(spark: SparkSession, table: str, today: dt.date) -> None:
    add_month_partition(spark, table, add_months(today, 1))


def add_date_partition(spark: SparkSession, table: str, day: dt.date) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (date = DATE'{day}')")


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """Partition values of a table with one partition column."""
    shown = spark.sql(f"SHOW PARTITIONS {table}")
    return shown.select(F.to_date(F.element_at(F.split("partition", "="), 2)).alias("partition"))


def expired_months(spark: SparkSession, table: str, today: dt.date, keep: int = MONTHS_TO_KEEP) -> DataFrame:
    return partitions(spark, table).where(F.col("partition") <= F.lit(add_months(today, -keep)))


def drop_expired(spark: SparkSession, table: str, today: dt.date, keep: int = MONTHS_TO_KEEP) -> int:
    """Drop the month partitions that are ``keep`` or more months old; one row per month is fetched."""
    months = [r["partition"] for r in expired_months(spark, table, today, keep).collect()]
    for month in months:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (month = DATE'{month}')")
    return len(months)


def missing_dates(spark: SparkSession, existing: DataFrame, start: dt.date, end: dt.date, date_col: str = "partition") -> DataFrame:
    """Calendar days of the range that have no partition."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(date_col))
    return days.join(existing.select(date_col).distinct(), [date_col], "left_anti")


def sync_dates(spark: SparkSession, table: str, start: dt.date, end: dt.date) -> int:
    """Register the dates of the range that lie in the table's folder and have no partition yet.

    The rule is the same for one date and for many; one statement adds them all. The folder's dates are
    taken from its listing.
    """
    described = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    known = {r["partition"] for r in partitions(spark, table).collect()}
    days = [day for day in listed_dates(spark, described) if start <= day <= end and day not in known]
    if days:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION (date = DATE'{day}')" for day in days))
    return len(days)
