"""Small helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def payload(column: Column | str) -> Column:
    """The bytes of a text; NULL counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("binary"), F.lit(b"").cast("binary"))


def text_bytes(df: DataFrame, text: str) -> int:
    """Total size of a text column; one number, summed in the tasks."""
    return df.agg(F.sum(F.octet_length(F.col(text).cast("binary")).cast("long"))).first()[0] or 0


def parts_for(df: DataFrame, text: str, target: int, least: int = 1) -> int:
    """An odd number of parts of about ``target`` bytes of text each."""
    n = max(least, -(-text_bytes(df, text) // target))
    return n + (n % 2 == 0)


def gathered(batches: Iterator[pa.RecordBatch], column: str, target: int) -> Iterator[pa.Table]:
    """Arrow batches put together or cut until ``column`` holds about ``target`` bytes."""
    held, size = [], 0
    for batch in batches:
        at, column_at = 0, batch.schema.get_field_index(column)
        while at < batch.num_rows:
            step = batch.num_rows - at
            while step > 1 and batch.column(column_at).slice(at, step).nbytes > target:
                step = (step + 1) // 2
            piece = batch.slice(at, step)
            held.append(piece)
            size += piece.column(column_at).nbytes
            at += step
            if size >= target:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def spread(files: DataFrame, key: str) -> DataFrame:
    """A short list of files dealt out to as many tasks, however few bytes the list has."""
    return files.repartition(max(1, files.count()), key)


_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers of a session this package, which need not be installed there."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SENT.add(app)
