"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring; a key belongs to the arc that ends at the next
point clockwise. A shard takes rows up to its bound; rows beyond it go on clockwise to the
next shard that has room. With bounds that add up to the number of rows, the counts of any two shards
differ by at most one, and only the overflow leaves its natural shard.

Only counts per arc (as many as there are points) reach the driver, where the ring is
filled with whole intervals of ranks. Rows find their rank in the order of the ring, and with
it their interval, shard and slot by arithmetic; no shard or arc is gathered anywhere.

Defined results: NULL texts have no bytes; NULL ids hash like any value; repeated ids and
rows are kept apart by their place in the order; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.context import cut_lineage

POINTS = 256  # virtual nodes per shard
OVERHEAD = 16  # bytes a row costs besides its text

PLACED = "doc_id long, size long, text_crc32 long, home int, shard int, slot long"


@dataclass(frozen=True)
class Ring:
    """Points in ascending order and the shard that owns each."""

    points: np.ndarray
    owners: np.ndarray

    @classmethod
    def build(cls, shards: int, points: int = POINTS) -> Ring:
        names = [(s, v) for s in range(shards) for v in range(points)]
        at = np.array([_spread(zlib.crc32(f"shard-{s}".encode()) << 32 | zlib.crc32(f"{s}/{v}".encode())) for s, v in names], np.uint64)
        order = np.lexsort(([s for s, _ in names], at))
        return cls(at[order], np.array([s for s, _ in names], np.int64)[order])

    def arc(self, position: np.ndarray) -> np.ndarray:
        """Index of the next point clockwise."""
        return np.searchsorted(self.points, position) % len(self.points)


def _spread(x: int) -> int:
    x = (x ^ (x >> 31)) * 0x9E3779B97F4A7C15 % (1 << 64)
    return (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64)


def even_bounds(rows: int, shards: int) -> np.ndarray:
    """Bounds that add up to ``rows`` and differ by at most one."""
    return np.full(shards, rows // shards, np.int64) + (np.arange(shards) < rows % shards)


def fill(ring: Ring, counts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Deal the rows of every arc to shards.

    First all shards take from their own arcs, in ring order, up to their bound. What is
    left walks clockwise, arc by arc, to the next shard with room. Returns intervals
    (arc, first rank in the arc, count, shard, first slot), ordered by arc and rank.
    """
    room = bounds.astype(np.int64).copy()
    used = np.zeros(len(bounds), np.int64)
    dealt: list[tuple[int, int, int, int, int]] = []

    def take(arc: int, rank: int, count: int, shard: int) -> int:
        n = int(min(count, room[shard]))
        if n:
            dealt.append((arc, rank, n, shard, int(used[shard])))
            room[shard] -= n
            used[shard] += n
        return n

    over = []
    for arc, count in enumerate(counts.tolist()):
        n = take(arc, 0, count, int(ring.owners[arc]))
        if n < count:
            over.append((arc, n, count - n))
    size = len(ring.owners)
    for arc, rank, count in over:
        step = arc
        for _ in range(size):
            if not count:
                break
            step = (step + 1) % size
            n = take(arc, rank, count, int(ring.owners[step]))
            rank, count = rank + n, count - n
        if count:
            raise ValueError("the bounds hold fewer rows than there are")
    return np.array(sorted(dealt), np.int64).reshape(-1, 5)


def _arcs(ring: Ring):
    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(batch.schema.get_field_index("position")).to_numpy().view(np.uint64)
            yield batch.append_column("arc", pa.array(ring.arc(at).astype(np.int32)))

    return arcs


def _place(ring: Ring, first: np.ndarray, intervals: np.ndarray, offsets: dict[int, int]):
    begins = first[intervals[:, 0]] + intervals[:, 1]  # global ranks
    order = np.argsort(begins, kind="stable")
    begins, shards, slots = begins[order], intervals[order, 3], intervals[order, 4]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda name: batch.column(batch.schema.get_field_index(name))
            mark = get("mark").to_numpy()
            part, index = mark >> 33, mark & ((1 << 33) - 1)
            names, inverse = np.unique(part, return_inverse=True)
            rank = np.array([offsets[p] for p in names.tolist()], np.int64)[inverse] + index
            at = np.searchsorted(begins, rank, side="right") - 1
            home = ring.owners[get("arc").to_numpy()]
            yield pa.record_batch(
                [get("doc"), get("size"), get("crc"), pa.array(home.astype(np.int32)), pa.array(shards[at].astype(np.int32)), pa.array(slots[at] + rank - begins[at])],
                names=[f.split()[0] for f in PLACED.split(", ")],
            )

    return place


def shard_rows(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", points: int = POINTS) -> DataFrame:
    """Shard and slot for every row: doc_id, size, text_crc32, home (the shard without bounds), shard, slot."""
    ring = Ring.build(shards, points)
    text = F.col(text_col).cast("binary")
    rows = df.select(
        F.col(id_col).cast("long").alias("doc"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0).cast("long")).alias("crc"),
        F.xxhash64(F.col(id_col).cast("long"), F.lit("ring")).alias("position"),
    )
    keyed = cut_lineage(rows.mapInArrow(_arcs(ring), "doc long, size long, crc long, position long, arc int"))
    order = ["arc", "position", "doc", "crc", "size"]
    ordered = cut_lineage(keyed.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("mark", F.monotonically_increasing_id())
    part = F.shiftright("mark", 33).alias("part")
    offsets, total = {}, 0
    for p, n in sorted((r.part, r.n) for r in ordered.groupBy(part).agg(F.count("*").alias("n")).collect()):
        offsets[p] = total
        total += n
    counts = np.zeros(len(ring.owners), np.int64)
    for r in keyed.groupBy("arc").agg(F.count("*").alias("n")).collect():
        counts[r.arc] = r.n
    first = np.cumsum(counts) - counts
    intervals = fill(ring, counts, even_bounds(total, shards))
    if not len(intervals):
        return df.sparkSession.createDataFrame([], PLACED)
    return ordered.mapInArrow(_place(ring, first, intervals, offsets), PLACED)
