"""Detector counts over an event stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corridor_metrics.functions.dates import joined_spans, spans_of
from corridor_metrics.operators.counts import VEHICLE_DETECTOR_ON, period_counts, with_phase
from corridor_metrics.sources import versions
from corridor_metrics.sources.lake import listed_dates

KEYS = ["timeperiod", "signalid", "eventparam"]
COLUMNS = ["date", *KEYS, "vol"]
ROWS = "timeperiod timestamp_ntz, signalid bigint, eventparam bigint, vol bigint, date date"
BASE, DELTAS = "base", "deltas"
MERGE_EVERY = 16


def event_stream(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Event files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_available(
    events: DataFrame, out: str, checkpoint: str, units: str = "hours", event_code: int = VEHICLE_DETECTOR_ON,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Count what has arrived and stop; the checkpoint remembers how far the stream got.

    Every batch writes its own counts per period, signal and detector into the folder
    of its number. A batch that runs again replaces that folder, so nothing counts
    twice. No state is held and no watermark is needed: an event adds to its period
    however late it comes, and open periods are there as well. After every ``merge_every`` batches the folders
    are merged into the base.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        merged = versions.newest(spark, out).get("batch", -1)
        if number <= merged:  # runs again after its merge
            return
        counts = period_counts(batch, units, event_code).withColumn("date", F.to_date("timeperiod"))
        counts.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            "date"
        ).parquet(f"{out}/{DELTAS}/batch={number}")
        if number - merged >= merge_every:
            merge(spark, out, number)

    return (
        events.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _open_batches(spark: SparkSession, out: str, after: int) -> list[int]:
    """Numbers of the batch folders that are not in the base, by their names."""
    names = [n.removeprefix("batch=") for n in versions.names_in(spark, f"{out}/{DELTAS}")]
    return sorted(int(n) for n in names if n.isdigit() and int(n) > after)


def _parts(spark: SparkSession, out: str, state: Mapping, batches: list[int]) -> list[DataFrame]:
    """The base, and the counts of some batches; a batch without counts has no files."""
    folders = [f"{out}/{DELTAS}/batch={n}" for n in batches]
    filled = [folder for folder in folders if listed_dates(spark, folder)]
    parts = [spark.read.option("basePath", f"{out}/{DELTAS}").parquet(*filled).select(*COLUMNS)] if filled else []
    return [*parts, *([versions.read_table(spark, out, BASE, state).select(*COLUMNS)] if BASE in state["tables"] else [])]


def merge(spark: SparkSession, out: str, last: int | None = None, most_versions: int = MERGE_EVERY) -> int:
    """Add the batches up to ``last`` to the base and record that number with it; returns how many were added.

    Only the dates that occur in these batches are written anew, as a version that becomes current
    together with the number: before that the batches count, after that the base does. Where the base would lie in more than
    ``most_versions`` folders, all its dates are written anew. Batch folders that
    the state before already had in its base are removed.
    """
    state = versions.newest(spark, out)
    merged = state.get("batch", -1)
    batches = [n for n in _open_batches(spark, out, merged) if last is None or n <= last]
    if not batches:
        return 0
    days = spans_of({day for n in batches for day in listed_dates(spark, f"{out}/{DELTAS}/batch={n}")})
    spans = state["tables"].get(BASE, [])
    if len({v for v, *_ in spans}) >= most_versions:
        days = joined_spans([*days, *((dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for _, a, b in spans)])
    parts = _parts(spark, out, state, batches)
    tables = {}
    if parts:
        touched = reduce(or_, [F.col("date").between(F.lit(first), F.lit(end)) for first, end in days], F.lit(False))
        tables[BASE] = _added_up(reduce(DataFrame.unionByName, parts).where(touched))
    versions.publish_dates(spark, out, tables, days, batch=batches[-1])
    for n in _open_batches(spark, out, -1):
        if n <= merged:
            versions.remove(spark, f"{out}/{DELTAS}/batch={n}")
    versions.prune(spark, out)
    return len(batches)


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date", *KEYS).agg(F.sum("vol").alias("vol"))


def folders_read(spark: SparkSession, out: str) -> int:
    """How many versions and batch folders a read of the counts touches."""
    state = versions.newest(spark, out)
    return len({s[0] for s in state["tables"].get(BASE, [])}) + len(_open_batches(spark, out, state.get("batch", -1)))


def streamed_counts(spark: SparkSession, out: str, det_config: DataFrame) -> DataFrame:
    """The counts of all batches so far, added up, with the phase of the detector.

    Equal to ``detector_counts`` over all events that have arrived. The base and the few batches after it are
    read. A condition on ``timeperiod`` may be put on ``date`` too, which prunes the folders.
    """
    state = versions.newest(spark, out)
    parts = _parts(spark, out, state, _open_batches(spark, out, state.get("batch", -1)))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], ROWS).select(*COLUMNS)
    return with_phase(_added_up(rows), det_config).select("signalid", "timeperiod", "eventparam", "CallPhase", "vol", "date")
