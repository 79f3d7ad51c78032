import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corridor_metrics.llm import suffix_dedup
from corridor_metrics.llm.gsaca import common_prefixes, suffix_array
from corridor_metrics.llm.queries import QUERIES
from edge_cases import edges, nothing, shipped  # noqa: F401


def test_suffix_array_against_sorting():
    rng = random.Random(1)
    for _ in range(500):
        a = [rng.randint(0, rng.choice([0, 1, 2, 5])) for _ in range(rng.randint(0, 40))]
        assert suffix_array(a).tolist() == sorted(range(len(a)), key=lambda i: a[i:])


def test_common_prefixes():
    data = np.frombuffer(b"banana bandana", np.uint8)
    order = suffix_array(data)
    places, ends = np.arange(len(data)), np.full(len(data), len(data))
    got = common_prefixes(data, places, ends, order, 4)
    text = data.tobytes()
    for i in range(1, len(order)):
        a, b = text[order[i - 1] :], text[order[i] :]
        assert got[i] == min(4, next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b))))


@pytest.mark.parametrize("seed", range(4))
def test_repeated_windows_against_a_set(seed):
    rng = random.Random(seed)
    pool = [b"l\xc3\xa9 ", b"he ", b"eres ", b"abcd", b"x", b"\n", b"nn ", b"  "]
    for _ in range(40):
        base = b"".join(rng.choice(pool) for _ in range(300))
        texts = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randint(0, len(base) - 100)
            texts.append(base[at : at + rng.randint(0, 160)] if rng.random() < 0.5 else (rng.choice(pool) * 80)[: rng.randint(90, 200)])
        texts = [t for t in texts if t]
        if not texts:
            continue
        ends = np.cumsum([len(t) for t in texts])
        starts = ends - [len(t) for t in texts]
        seen, want = set(), []
        for t, a in zip(texts, starts.tolist()):
            for p in range(len(t) - 99):
                if t[p : p + 100] in seen:
                    want.append(a + p)
                seen.add(t[p : p + 100])
        got = suffix_dedup.repeated_windows(np.frombuffer(b"".join(texts), np.uint8), starts, ends, 100)
        assert got.tolist() == want


def brute(rows, width=100):
    """Windows in a set, documents in order; repeated rows are one document."""
    seen, done, out = set(), {}, []
    for doc, text in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], suffix_crc(r[1]))):
        data = (text or "").encode()
        if (doc, data) not in done:
            covered = bytearray(len(data))
            for p in range(len(data) - width + 1):
                window = data[p : p + width]
                if window in seen:
                    covered[p : p + width] = b"\1" * width
                else:
                    seen.add(window)
            spans = sum(1 for i, c in enumerate(covered) if c and not (i and covered[i - 1]))
            left = bytes(b for b, c in zip(data, covered) if not c)
            done[doc, data] = (doc, len(data), sum(covered), spans, hashlib.sha256(left).hexdigest())
        out.append(done[doc, data])
    return sorted(out, key=repr)


def suffix_crc(text):
    import zlib

    return zlib.crc32((text or "").encode())


def rows_of(df):
    digests = df.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("removed").alias("n_spans"), F.sha2("kept", 256)
    )
    return sorted((tuple(r) for r in digests.collect()), key=repr)


def test_edges(edges, nothing):
    pairs = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    assert rows_of(suffix_dedup.drop_repeats(edges)) == brute(pairs)
    assert rows_of(suffix_dedup.drop_repeats(edges, part_bytes=1 << 14)) == brute(pairs)
    assert rows_of(suffix_dedup.drop_repeats(nothing)) == []


def test_common_passages_by_their_own_hash(spark, monkeypatch):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    shared = " ".join(rng.choice(words) for _ in range(40))
    rows = [(i, " ".join(rng.choice(words) for _ in range(30)) + " " + shared + " " + " ".join(rng.choice(words) for _ in range(30))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    docs = df.select(F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("text"))
    assert len(suffix_dedup.hot_anchors(docs, 100)) > 0
    assert rows_of(suffix_dedup.drop_repeats(df)) == brute(rows)


def test_rows_are_dealt_over_all_parts(spark):
    """Ids in steps of the number of parts, and rows without an id, don't fall into one part."""
    parts = 13
    ids = [*range(0, parts * 2000, parts), -5, -(2**62), 2**63 - 1]
    rows = [*((i, f"text {i}") for i in ids), *((None, f"text {i}") for i in range(1000))]
    df = spark.createDataFrame(rows, "doc long, text string").withColumn("crc", F.crc32("text"))
    got = df.select("doc", "crc", suffix_dedup._part_column(parts).alias("part")).collect()
    doc = np.array([suffix_dedup.NO_ID if r.doc is None else r.doc for r in got], np.int64)
    crc = np.array([r.crc for r in got], np.uint32)
    assert suffix_dedup._part_of(doc, crc, parts).tolist() == [r.part for r in got]
    for some in ([r.part for r in got if r.doc is None], [r.part for r in got if r.doc is not None]):
        counts = np.bincount(some, minlength=parts)
        assert counts.min() > 0 and counts.max() < 2 * len(some) / parts


def test_ids_in_steps_and_passages_below_hot(spark):
    """A passage in 0.4 % of the texts, ids that are multiples of the part count, rows without an id."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(3000)]
    shared = " ".join(rng.choice(words) for _ in range(30))
    rows = []
    for i in range(1500):
        text = " ".join(rng.choice(words) for _ in range(20))
        rows.append((None if i % 100 == 7 else 13 * i, text + (" " + shared + " end" if i % 250 == 0 else "")))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = rows_of(suffix_dedup.drop_repeats(df))
    assert got == brute(rows) and sum(r[2] > 0 for r in got) == 5


def test_short_document_before_a_long_one(spark):
    """The long text passes the short one in its task, but the short one has the smaller id."""
    rng = random.Random(6)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(1000))
    long = "".join(rng.choice("ijklmnop ") for _ in range(600_000))
    rows = [(1, "short " + shared + " end"), (2, long[:300_000] + shared + long[300_000:])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    docs = df.select(F.col("doc_id").alias("doc"), F.col("text").cast("binary").alias("text"))
    assert len(suffix_dedup.hot_anchors(docs, 100)) == 0
    got = rows_of(suffix_dedup.drop_repeats(df))
    assert got == brute(rows) and [r[2] > 0 for r in got] == [False, True]


def test_query_on_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op3_suffix_dedup"](spark, small).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
