"""SimHash near-duplicates by pigeonhole blocks, and their connected components.

A text's 64-bit fingerprint has a bit for each that is set in over half its shingles'
hashes. Fingerprints that differ in at most ``bits`` bits agree on all but ``bits`` of any
blocks they are cut into, so close pairs share the rest of the blocks. Rows are distinct
fingerprints, whatever the number of copies. They meet by shared blocks, and Hamming distance is verified in the task that holds
a bucket; a bucket gives a spanning forest of its links, never all pairs. More blocks, and
so longer keys, are used for more fingerprints; buckets beyond ``BUCKET`` are cut into
cells, each a pair of slices.

Components are found by alternating star contraction over the links, checkpointed in
each round.

Defined results: NULL and wordless texts have fingerprint zero and link like any other; fewer words
than a shingle make one shingle; the component id is the least id (NULL only if all are
NULL); repeated rows give equal rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor_metrics.context import cut_lineage
from corridor_metrics.llm.common import gathered, payload
from corridor_metrics.llm.exact_dedup import FOLD

SHINGLE = 3
BITS = 3
SEED = 42
BUCKET = 20_000  # fingerprints compared in one task
PAIRWISE = 8  # buckets up to this size are compared pair by pair, side by side
HASHES = 1 << 15  # hashes unpacked at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of a text."""
    from xxhash import xxh64_intdigest

    words = text.translate(FOLD).split()
    n = max(1, len(words) - shingle + 1) if words else 0
    if not n:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, HASHES):
        values = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + HASHES], stops[at : at + HASHES])], "<u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _prints(shingle: int, carried: tuple[str, ...] = ()):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", 4 << 20):
            found = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            columns = [batch.column(c).combine_chunks() for c in ("doc_id", *carried)]
            yield pa.record_batch([*columns, pa.array(found)], names=["doc_id", *carried, "print"])

    return prints


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, carried: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, the ``carried`` string columns, print (the fingerprint as a signed 64-bit number)."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), *carried, payload(text_col).alias("text"))
    return docs.mapInArrow(_prints(shingle, carried), ", ".join(["doc_id long", *(f"{c} string" for c in carried), "print long"]))


def block_masks(n: int, bits: int = BITS) -> list[int]:
    """Masks of the block sets to meet by: enough key bits that random buckets stay small."""
    blocks = bits + 1
    while 64 * (blocks - bits) / blocks < 52 and n > 8 * 2 ** (64 * (blocks - bits) / blocks):
        blocks += 1
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - bits)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(prints: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of one bucket: every fingerprint is compared with those not reached yet."""
    left, links = prints, []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= bits
            if near.any():
                reached = left[near]
                links += [(x, y) for y in reached]
                front += list(reached)
                left = left[~near]
    return links


def links_of_buckets(bucket: np.ndarray, prints: np.ndarray, bits: int) -> np.ndarray:
    """Links among fingerprints with equal bucket numbers; rows are sorted by bucket."""
    _, heads, sizes = np.unique(bucket, return_index=True, return_counts=True)
    found = []
    small = np.repeat(sizes <= PAIRWISE, sizes)
    a, s = prints[small], bucket[small]
    for step in range(1, PAIRWISE):
        if len(a) <= step:
            break
        near = np.flatnonzero((s[step:] == s[:-step]) & (np.bitwise_count(a[step:] ^ a[:-step]) <= bits))
        found.append(np.stack([a[near], a[near + step]], axis=1))
    for head, size in zip(heads[sizes > PAIRWISE].tolist(), sizes[sizes > PAIRWISE].tolist()):
        found.append(np.array(_forest(prints[head : head + size], bits), np.uint64).reshape(-1, 2))
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


def _links(bits: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table.column(c).to_numpy() for c in ("space", "key", "low", "high")])
            fresh = np.ones(keys.shape[1], bool)
            fresh[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
            pairs = links_of_buckets(np.cumsum(fresh), table.column("print").to_numpy().view(np.uint64), bits).view(np.int64)
            pairs = np.unique(np.sort(pairs, axis=1), axis=0)
            return pa.record_batch([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            last = [table.column(c)[-1].as_py() for c in ("space", "key", "low", "high")]
            same = np.logical_and.reduce([table.column(c).to_numpy() == v for c, v in zip(("space", "key", "low", "high"), last)])
            cut = int(np.argmax(same)) if len(same) else 0
            held = table.slice(cut)
            if cut:
                yield emit(table.slice(0, cut))
        if held is not None and held.num_rows:
            yield emit(held)

    return links


def close_links(prints: DataFrame, bits: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``bits`` bits of each other."""
    distinct = prints.select("print").distinct()
    masks = block_masks(distinct.count(), bits)
    keys = F.array(*[F.col("print").bitwiseAND(F.lit(_signed(m))) for m in masks])
    rows = distinct.select("print", F.posexplode(keys).alias("space", "key"))
    sizes = rows.groupBy("space", "key").agg(F.count("*").alias("n")).where("n > 1")
    slices = F.ceil(F.col("n") / bucket).cast("int")
    own = F.pmod(F.xxhash64("print"), F.col("slices")).cast("int")
    cells = rows.join(sizes.withColumn("slices", slices).drop("n"), ["space", "key"]).withColumn("own", own)
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).select(
        "space", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "print"
    )
    place = ["space", "key", "low", "high"]
    return cells.repartition(*place).sortWithinPartitions(*place, "print").mapInArrow(_links(bits), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node; the root is the least node of its component.

    Large stars point the larger neighbours of a node at its least neighbour, small stars
    the smaller ones. Both use minima combined before the shuffle and a join, so a node with
    very many links is not gathered. Each round is checkpointed; the links are a forest of
    stars when a round changes nothing.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut_lineage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    before = state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        large = cut_lineage(large)
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(down.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.where("a != b").distinct())
        after = state(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = after


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS, bucket: int = BUCKET,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``df``: doc_id, the ``carried`` string columns, print, component_id, root.

    ``root`` is the least fingerprint of the component and names it; ids can be NULL or repeat.
    """
    prints = cut_lineage(fingerprints(df, id_col, text_col, shingle, carried))
    roots = components(close_links(prints, bits, bucket))
    least = prints.groupBy("print").agg(F.min("doc_id").alias("least"))
    rooted = cut_lineage(
        least.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("print", "component_id", "root")
    return prints.join(named, "print").select("doc_id", *carried, "print", "component_id", "root")


def hex_print(column: str) -> Column:
    """Sixteen lower-case digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))
