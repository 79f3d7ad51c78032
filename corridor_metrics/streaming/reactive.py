"""Refresh of a small shared table whenever its source changes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corridor_metrics.context import cut_lineage
from corridor_metrics.sources import versions
from corridor_metrics.sources.lake import manifest

POLL_SECONDS = 3600
VALUE, FILES = "value", "files"


def current(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the last refresh. A refresh that runs meanwhile changes nothing for this reader."""
    return versions.read_table(spark, target, VALUE)


def refresh(
    spark: SparkSession, source: str, schema: StructType, target: str,
    value: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> bool:
    """Publish a new version of ``target`` from the whole source if any of its files is new, gone or changed.

    Paths, lengths and times of the files are compared with those of the last refresh, which are
    published together with the rows: a run that fails in between leaves both as they were.
    Returns whether a version was published. Superseded versions are removed at the next but one.
    """
    files = cut_lineage(manifest(spark, source).select("path", "length", "last_modified"))
    state = versions.newest(spark, target)
    seen = versions.read_table(spark, target, FILES, state) if FILES in state["tables"] else files.limit(0)
    if files.exceptAll(seen).union(seen.exceptAll(files)).isEmpty():
        return False
    whole = spark.read.schema(schema).parquet(source)
    versions.publish_tables(spark, target, {VALUE: value(whole), FILES: files})
    versions.prune(spark, target)
    return True


def refresh_on_change(
    spark: SparkSession, source: str, schema: StructType, target: str, state: str,
    interval_seconds: float = POLL_SECONDS, value: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> StreamingQuery:
    """Poll a folder and ``refresh`` the target; the stream is only the clock, its progress is kept in ``state``."""

    def poll(batch: DataFrame, batch_id: int) -> None:
        refresh(spark, source, schema, target, value)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    writer = clock.writeStream.foreachBatch(poll).option("checkpointLocation", f"{state}/clock")
    return writer.trigger(processingTime=f"{interval_seconds} seconds").start()
