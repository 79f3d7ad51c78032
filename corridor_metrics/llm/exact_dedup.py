"""Exact duplicates by composable polynomial fingerprints, confirmed chunk by chunk.

A text's fingerprint is its polynomial value modulo two primes. Chunks are hashed on
their own and combined by arithmetic shifted by length. The chunks of a text above ``LONG``
bytes are rows of their own, dealt over all tasks: each is hashed, shifted by the bytes that
follow it, and an aggregate adds them up; the value is the one a single task would get. Texts with one fingerprint and length are then compared: their chunks meet
by fingerprint and chunk number, and the least and the greatest chunk must be equal. This is
combined in the tasks before the shuffle, so a group of any size is never gathered. Groups
that fail are split by their SHA-256.

Defined results: NULL counts as empty, and all empty texts are one group; texts are equal
when they are equal after lower-casing A-Z; the row with the largest id stays (a NULL id only
where there is no other); of rows that repeat both id and text one stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor_metrics.context import cut_lineage
from corridor_metrics.llm.common import gathered, payload

CHUNK = 1 << 16
LONG = 1 << 20  # bytes; the chunks of longer texts are hashed in different tasks
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_566_083_941)
FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

PRINTS = "doc_id long, n_bytes long, print_a long, print_b long, text_sha256 string"


def _falling_powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.empty(n, np.int64)
    value = 1
    for i in range(n - 1, -1, -1):
        out[i] = value
        value = value * base % prime
    return out


class Fingerprint:
    """Value of a byte string as a polynomial, with its length; ``+`` joins two strings."""

    __slots__ = ("size", "values")
    powers: list[np.ndarray] = []

    def __init__(self, values: tuple[int, ...] = (0, 0), size: int = 0):
        self.values, self.size = values, size

    @classmethod
    def of(cls, chunk: bytes) -> Fingerprint:
        """Of at most ``CHUNK`` bytes: one product with the powers of each base."""
        if not cls.powers:
            cls.powers = [_falling_powers(b, p, CHUNK) for b, p in zip(BASES, PRIMES)]
        n = len(chunk)
        data = np.frombuffer(chunk, np.uint8).astype(np.int64) + 1
        return cls(tuple(int(data @ w[CHUNK - n :]) % p for w, p in zip(cls.powers, PRIMES)), n)

    def __add__(self, other: Fingerprint) -> Fingerprint:
        shifted = (a * pow(base, other.size, prime) + b for a, b, base, prime in zip(self.values, other.values, BASES, PRIMES))
        return Fingerprint(tuple(v % p for v, p in zip(shifted, PRIMES)), self.size + other.size)


def fingerprint(data: bytes) -> Fingerprint:
    total = Fingerprint()
    for at in range(0, len(data), CHUNK):
        total = total + Fingerprint.of(data[at : at + CHUNK])
    return total


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in gathered(batches, "text", 4 << 20):
        rows = []
        for text in batch.column("text").to_pylist():
            data = text.translate(FOLD)
            mark = fingerprint(data)
            rows.append((mark.size, *mark.values, hashlib.sha256(data).hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.record_batch(
            [batch.column("doc_id").combine_chunks(), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string())))],
            names=[f.split()[0] for f in PRINTS.split(", ")],
        )


SHIFTED = "doc_id long, text_sha256 string, n_bytes long, chunk long, part_a long, part_b long"


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of folded chunks, shifted by the number of bytes behind them."""
    keys = ["doc_id", "text_sha256", "n_bytes", "chunk"]
    for batch in gathered(batches, "data", 4 << 20):
        parts = []
        for size, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("n_bytes", "chunk", "data"))):
            behind = size - chunk * CHUNK - len(data)
            values = Fingerprint.of(data.translate(FOLD)).values
            parts.append([v * pow(b, behind, p) % p for v, b, p in zip(values, BASES, PRIMES)])
        sums = [pa.array([x[i] for x in parts], pa.int64()) for i in (0, 1)]
        yield pa.record_batch([*(batch.column(c).combine_chunks() for c in keys), *sums], names=[*keys, "part_a", "part_b"])


def folded_sha(text: str) -> Column:
    """SHA-256 of a folded text."""
    return F.sha2(F.translate(F.col(text).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)


def chunk_rows(docs: DataFrame) -> DataFrame:
    """The chunks of texts (doc_id, text), a row each, dealt by text and number."""
    whole = ["doc_id", "text_sha256", "n_bytes"]
    size = F.octet_length("text").cast("long")
    texts = docs.select("doc_id", folded_sha("text").alias("text_sha256"), size.alias("n_bytes"), "text").where("n_bytes > 0")
    numbers = F.sequence(F.lit(0).cast("long"), F.expr(f"(n_bytes - 1) div {CHUNK}"))
    cut = texts.withColumn("chunk", F.explode(numbers)).withColumn("data", F.expr(f"substring(text, CAST(chunk * {CHUNK} + 1 AS INT), {CHUNK})"))
    return cut.select(*whole, "chunk", "data").repartition(*whole, "chunk")


def long_prints(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts (doc_id, text; none empty) from chunks that are hashed in different tasks.

    Repeated rows have equal chunks, of which one is added and the number kept.
    """
    whole = ["doc_id", "text_sha256", "n_bytes"]
    chunks = chunk_rows(docs).mapInArrow(_shifted, SHIFTED).groupBy(*whole, "chunk").agg(
        F.max("part_a").alias("part_a"), F.max("part_b").alias("part_b"), F.count("*").alias("times"),
    )
    sums = [(F.sum(c) % p).alias(name) for c, p, name in zip(("part_a", "part_b"), PRIMES, ("print_a", "print_b"))]
    texts = chunks.groupBy(*whole).agg(*sums, F.max("times").alias("times"))
    texts = texts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return texts.select("doc_id", "n_bytes", "print_a", "print_b", "text_sha256")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of folded texts, with the group and the number of each."""
    for batch in gathered(batches, "text", 4 << 20):
        keys = [batch.column(c).to_pylist() for c in ("n_bytes", "print_a", "print_b", "text")]
        rows = []
        for size, a, b, text in zip(*keys):
            data = text.translate(FOLD)
            rows += [(size, a, b, at // CHUNK, data[at : at + CHUNK]) for at in range(0, len(data), CHUNK)]
        if rows:
            columns = zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))
            yield pa.record_batch([pa.array(c, t) for c, t in columns], names=["n_bytes", "print_a", "print_b", "chunk", "data"])


KEY = ["n_bytes", "print_a", "print_b"]


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col).alias("text"))
    is_long = F.octet_length("text") > LONG
    return docs.where(~is_long).mapInArrow(_prints, PRINTS).unionByName(long_prints(docs.where(is_long)))


def unequal_groups(df: DataFrame, prints: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Keys of groups in which texts differ although their fingerprints agree.

    Texts that occur more than once are read again and compared chunk by chunk. Rows with a NULL
    id meet their own fingerprint by the SHA-256 of the folded text as well, as they share no id.
    """
    text_key = F.when(F.col("doc_id").isNull(), F.col("text_sha256"))
    several = prints.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1 and n_bytes > 0").select(*KEY)
    members = prints.withColumn("text_key", text_key).join(several, KEY, "left_semi")
    members = members.groupBy("doc_id", "text_key", *KEY).agg(F.count("*").alias("n")).drop("n")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col).alias("text"))
    docs = docs.select("*", F.octet_length("text").cast("long").alias("size"), F.when(F.col("doc_id").isNull(), folded_sha("text")).alias("sha"))
    own = docs["doc_id"].eqNullSafe(members["doc_id"]) & (docs["size"] == members["n_bytes"]) & docs["sha"].eqNullSafe(members["text_key"])
    texts = docs.join(members, own)
    chunks = texts.select(*KEY, "text").mapInArrow(_chunks, "n_bytes long, print_a long, print_b long, chunk long, data binary")
    ends = chunks.groupBy(*KEY, "chunk").agg(F.min("data").alias("least"), F.max("data").alias("most"))
    return ends.where("least != most").select(*KEY).distinct()


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = cut_lineage(fingerprints(df, id_col, text_col))
    unequal = unequal_groups(df, prints, id_col, text_col).withColumn("split", F.lit(True))
    rows = prints.groupBy("doc_id", *KEY, "text_sha256").agg(F.count("*").alias("times"))
    rows = rows.join(unequal, KEY, "left").withColumn("part", F.when(F.col("split"), F.col("text_sha256")).otherwise(F.lit("")))
    rows = cut_lineage(rows.drop("split"))
    groups = rows.groupBy(*KEY, "part").agg(
        F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size"),
    )
    copies = rows.join(groups, [*KEY, "part"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return copies.select(
        "doc_id", "keep_id", "group_size",
        ((F.col("copy") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )
