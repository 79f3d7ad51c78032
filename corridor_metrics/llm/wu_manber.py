"""Benchmark decontamination: Wu-Manber search for many word windows at once.

Texts and benchmark items become words; every window of ``width`` consecutive item words
is a pattern (an item of fewer words is one pattern). Symbols are words and a block is two
neighbouring words. For patterns of one length, the shift table tells how far the scan may
move for a block: blocks in no pattern skip almost a whole window. Where the shift is
zero, the bucket of the block names the patterns that end with it, and their words are
compared directly.

The patterns are dealt over blocks by the hash of window and item and stored in the shared folder, a folder
for each block, so that the driver never holds them. A task searches its texts in portions: for each
portion it goes through the blocks one after the other, and holds the tables of one block at a time. Memory thus
does not grow with the benchmark; the blocks of a large one are read once per portion. A portion begins with
the block that the one before ended with, so a single block is read once per worker.

Defined results: NULL or wordless texts have no words and no hits; NULL or wordless items
make no pattern; items of one text count each; NULL item ids are not counted; repeated rows
give equal rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.context import scratch_path
from corridor_metrics.llm.common import gathered, payload, text_bytes

WIDTH = 10
BLOCK_BYTES = 1 << 19  # benchmark text per block; its tables take some 170 times as much
CHUNK_BYTES = 8 << 20

# ASCII letters in lower case and digits stay, other ASCII becomes a space
_WORDS = bytes(b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def windows_of(words: list[bytes], width: int) -> list[tuple[bytes, ...]]:
    """All windows of an item; an item of fewer words is one, an item without words none."""
    size = min(width, len(words))
    return [tuple(words[at : at + size]) for at in range(len(words) - size + 1)] if size else []


class WindowSearch:
    """Tables for some windows, each with the items that hold it."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int = WIDTH):
        self._build((window, name) for name, text in items for window in windows_of(words_of(text), width))

    @classmethod
    def of_patterns(cls, patterns: Iterable[tuple[tuple[bytes, ...], str | None]]) -> WindowSearch:
        search = cls.__new__(cls)
        search._build(patterns)
        return search

    def _build(self, patterns: Iterable[tuple[tuple[bytes, ...], str | None]]) -> None:
        owners: dict[tuple[bytes, ...], list[str]] = {}
        for window, name in patterns:
            names = owners.setdefault(window, [])
            if name is not None:
                names.append(name)
        self.owners = {window: frozenset(names) for window, names in owners.items()}
        self.tables: dict[int, tuple[dict, dict]] = {}
        for window in self.owners:
            size = len(window)
            shift, bucket = self.tables.setdefault(size, ({}, {}))
            if size == 1:
                continue
            for end in range(2, size + 1):
                block = window[end - 2 : end]
                shift[block] = min(shift.get(block, size), size - end)
            bucket.setdefault(window[-2:], set()).add(window)

    def find(self, words: list[bytes]) -> list[tuple[int, tuple[bytes, ...]]]:
        """(start, window) of every occurrence."""
        found = []
        n = len(words)
        for size, (shift, bucket) in self.tables.items():
            if size == 1:
                found += [(i, (w,)) for i, w in enumerate(words) if (w,) in self.owners]
                continue
            most, step = size - 1, shift.get
            end = size
            while end <= n:
                move = step((words[end - 2], words[end - 1]), most)
                if move:
                    end += move
                    continue
                candidate = tuple(words[end - size : end])
                if candidate in bucket[candidate[-2:]]:
                    found.append((end - size, candidate))
                end += 1
        return found


class StoredPatterns:
    """The blocks of patterns below a folder; the tables of one of them are held."""

    def __init__(self, folder: str, blocks: int):
        self.folder, self.blocks = folder, blocks
        self.number, self.held = -1, None

    def __iter__(self) -> Iterator[WindowSearch]:
        """The tables of each block once; those at hand come first, and are given up before the next are built."""
        for number in sorted(range(self.blocks), key=lambda k: k != self.number):
            if number != self.number:
                self.number, self.held = number, None
                self.held = self._load(number)
            yield self.held

    def _load(self, number: int) -> WindowSearch:
        system, path = pa.fs.FileSystem.from_uri(f"{self.folder}/block={number}")
        if system.get_file_info(path).type == pa.fs.FileType.NotFound:
            return WindowSearch.of_patterns(())
        rows = pq.read_table(path, columns=["window", "item"], filesystem=system, partitioning=None)
        return WindowSearch.of_patterns((tuple(w.split()), i) for w, i in zip(rows["window"].to_pylist(), rows["item"].to_pylist()))


def store_patterns(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_bytes: int) -> StoredPatterns:
    """Write every window of every item, with the item, dealt over blocks of about ``block_bytes`` of item text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), payload(text_col).alias("text"))
    blocks = max(1, -(-text_bytes(items, "text") // block_bytes))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", CHUNK_BYTES):
            for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                found = windows_of(words_of(text), width)
                for at in range(0, len(found), 10_000):
                    joined = [b" ".join(w) for w in found[at : at + 10_000]]
                    yield pa.record_batch([pa.array(joined, pa.binary()), pa.array([name] * len(joined), pa.string())], names=["window", "item"])

    folder = scratch_path(spark, "patterns")
    patterns = items.mapInArrow(windows, "window binary, item string").distinct()
    dealt = patterns.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(blocks)))
    dealt.hint("rebalance", "block").write.partitionBy("block").parquet(folder)
    return StoredPatterns(folder if ":" in folder.split("/")[0] else f"file://{folder}", blocks)


def _search(patterns: StoredPatterns):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", CHUNK_BYTES):
            texts = batch.column("text").to_pylist()
            counts: list[int] = [0] * len(texts)
            marks: list[np.ndarray | None] = [None] * len(texts)
            items: list[set[str] | None] = [None] * len(texts)
            for tables in patterns:
                for k, text in enumerate(texts):
                    words = words_of(text)
                    counts[k] = len(words)
                    for at, window in tables.find(words):
                        if marks[k] is None:
                            marks[k], items[k] = np.zeros(len(words), bool), set()
                        marks[k][at : at + len(window)] = True
                        items[k] |= tables.owners[window]
            columns = [
                batch.column("doc_id").combine_chunks(), batch.column("text").combine_chunks(), pa.array(counts, pa.int64()),
                pa.array([None if m is None else m.tobytes() for m in marks], pa.binary()),
                pa.array([None if x is None else sorted(x) for x in items], pa.list_(pa.string())),
            ]
            yield from pa.table(columns, names=["doc_id", "text", "n_words", "hits", "items"]).to_batches()

    return scan


def find_contamination(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, text, n_words, hits (one byte per word, NULL without hits), items (sorted, NULL without hits)."""
    patterns = store_patterns(benchmark, item_col, item_text_col, width, block_bytes)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col).alias("text"))
    return rows.mapInArrow(_search(patterns), "doc_id long, text binary, n_words long, hits binary, items array<string>")


def contamination_report(found: DataFrame) -> DataFrame:
    """Counts and digests of ``find_contamination``."""

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, words, hits, items = (batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "n_words", "hits", "items"))
            n_hit = [int(np.count_nonzero(np.frombuffer(h, "u1"))) if h else 0 for h in hits.to_pylist()]
            names = [x or [] for x in items.to_pylist()]
            yield pa.record_batch(
                [doc, words, pa.array(n_hit, pa.int64()), pa.array([len(x) for x in names], pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]), pa.array([x > 0 for x in n_hit])],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    return found.select("doc_id", "n_words", "hits", "items").mapInArrow(
        report, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    )


def contaminated(text, benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, block_bytes: int = BLOCK_BYTES):
    """Condition on a text column: it holds a window of some item."""
    patterns = store_patterns(benchmark, item_col, item_text_col, width, block_bytes)

    @F.arrow_udf("boolean")
    def hit(texts: pa.Array) -> pa.Array:
        found = np.zeros(len(texts), bool)
        for tables in patterns:
            for k, text in enumerate(texts):
                found[k] = found[k] or bool(tables.find(words_of(text.as_py())))
        return pa.array(found)

    return hit(payload(text))
