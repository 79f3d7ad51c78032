"""Removal of byte strings that occur earlier in the corpus, found by suffix sorting.

``drop_repeats`` removes every byte covered by a ``width``-byte string that also starts
earlier (in a smaller document, or further left in the same one).

1. Each task cuts its texts into runs of windows that share an anchor (``anchors``).
   Equal runs are combined in the task: all but the first are repeats.
2. Runs meet by anchor hash. Equal runs leave their first one. Where an anchor has several
   different runs, only parts of them may agree, and these runs ask for their bytes.
3. The bytes are fetched from the documents and meet by anchor again, a few megabytes to a
   part. Each part is suffix sorted by ``gsaca`` at content-defined token starts; windows are
   equal when their bytes up to the next token start are equal, and the suffixes behind it
   fall into one class of common prefixes of the length that is left.
4. The repeats of each document are merged, and its bytes cut out.

Anchors that very many texts share (lines, passages) would put all their runs into one part.
They are found in a sample first, and their windows are dealt by their own hash instead.
Which anchors are named there changes the plan, not the result.

Defined results: NULL counts as empty; texts shorter than ``width`` lose nothing; NULL ids
come first; rows with one id are ordered by the CRC-32 of their text; a row that repeats
another row's id and text is the same document, and gets the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor_metrics.context import cut_lineage
from corridor_metrics.llm.anchors import mix, runs
from corridor_metrics.llm.common import gathered, parts_for, payload
from corridor_metrics.llm.gsaca import common_prefixes, suffix_array

TASK_BYTES = 16 << 20  # text combined at a time in a task
PART_BYTES = 16 << 20  # text per part of the shuffles
HOT_SAMPLE = 20_000  # documents looked at for anchors that many texts share
HOT_SHARE = 0.005  # share of them that makes an anchor hot
NO_ID = np.int64(-(2**63))

RUN_MESSAGE = "bucket int, key binary, run binary, doc binary, crc binary, lo binary, span binary, hits binary"
DOC_MESSAGE = "part int, hits binary, asks binary"
SEGMENT_MESSAGE = "bucket int, refs binary, bytes binary"
HIT_MESSAGE = "part int, hits binary, asks binary"

HIT = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("lo", "<u4"), ("hi", "<u4")])
ASK = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("lo", "<u4"), ("span", "u1"), ("key", "<u8")])
REF = np.dtype([("doc", "<i8"), ("crc", "<u4"), ("lo", "<u4"), ("size", "<u2")])


def _hits(doc, crc, lo, hi) -> np.ndarray:
    """Ranges of repeated window starts, neighbouring ranges joined."""
    order = np.lexsort((lo, crc, doc))
    doc, crc, lo, hi = doc[order], crc[order], lo[order], hi[order]
    if len(doc):
        fresh = np.ones(len(doc), bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1]) | (lo[1:] > hi[:-1] + 1)
        heads = np.flatnonzero(fresh)
        doc, crc, lo, hi = doc[heads], crc[heads], lo[heads], np.maximum.reduceat(hi, heads)
    out = np.empty(len(doc), HIT)
    out["doc"], out["crc"], out["lo"], out["hi"] = doc, crc, lo, hi
    return out


def _split(values: np.ndarray, part: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(part, kind="stable")
    names, heads = np.unique(part[order], return_index=True)
    return dict(zip(names.tolist(), np.split(values[order], heads[1:])))


def _single_windows(texts: list[bytes], doc, lo, hi, width: int):
    """One run for each window of the given runs, named by the hash of the window."""
    count = hi - lo + 1
    which = np.repeat(np.arange(len(doc)), count)
    start = lo[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    owner = doc[which]
    key = np.empty(len(owner), np.uint64)
    powers = np.multiply.accumulate(np.full(width, 0xD1342543DE82EF95, np.uint64))
    for i in np.unique(owner):
        mine = np.flatnonzero(owner == i)
        view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(texts[i], np.uint8), width)
        for at in range(0, len(mine), 4096):
            chosen = mine[at : at + 4096]
            key[chosen] = mix(((view[start[chosen]].astype(np.uint64) + np.uint64(1)) * powers).sum(axis=1, dtype=np.uint64))
    return owner, start, start.copy(), key, key ^ np.uint64(0x5DEECE66D)


def _columns(batch: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    doc = batch.column("doc").fill_null(int(NO_ID)).to_numpy().astype(np.int64)
    return doc, batch.column("crc").to_numpy().astype(np.int64), batch.column("text").to_pylist()


def _run_keys(width: int):
    def anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", TASK_BYTES):
            texts = batch.column("text").to_pylist()
            pairs = [np.unique(np.stack([key, which.astype(np.uint64)]), axis=1)[0] for which, _, _, key, _ in runs(texts, width)]
            if pairs:
                keys, times = np.unique(np.concatenate(pairs), return_counts=True)
                many = times > 1
                yield pa.record_batch([pa.array(keys[many].view(np.int64)), pa.array(times[many])], names=["key", "times"])

    return anchors_of


def hot_anchors(docs: DataFrame, width: int, sample: int = HOT_SAMPLE, share: float = HOT_SHARE) -> np.ndarray:
    """Anchors of more than ``share`` of the texts in a sample: a bounded list, as a text has boundedly many such."""
    n = docs.count()
    if not n:
        return np.zeros(0, np.uint64)
    picked = docs.where(F.pmod(F.xxhash64("doc"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, sample / n)))
    times = picked.mapInArrow(_run_keys(width), "key long, times long").groupBy("key").agg(F.sum("times").alias("times"))
    rows = times.where(F.col("times") > max(30, share * min(sample, n))).orderBy(F.desc("times")).limit(100_000).collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


def _emit_runs(width: int, buckets: int, hot: np.ndarray):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", TASK_BYTES):
            doc, crc, texts = _columns(batch)
            order = np.lexsort((crc, doc))
            once = np.ones(len(order), bool)
            once[1:] = (doc[order][1:] != doc[order][:-1]) | (crc[order][1:] != crc[order][:-1])
            order = order[once]
            doc, crc, texts = doc[order], crc[order], [texts[i] for i in order]
            blocks = list(runs(texts, width))
            if not blocks:
                continue
            which, lo, hi, key, run = (np.concatenate(x) for x in zip(*blocks))
            if len(hot):
                common = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key
                single = _single_windows(texts, which[common], lo[common], hi[common], width)
                which, lo, hi, key, run = (np.concatenate([a[~common], b]) for a, b in zip((which, lo, hi, key, run), single))
            again = np.lexsort((lo, which))  # a long text's blocks come before the short texts in front of it
            which, lo, hi, key, run = which[again], lo[again], hi[again], key[again], run[again]
            both = mix(key + mix(run))
            order = np.argsort(both, kind="stable")
            first = np.ones(len(order), bool)
            first[1:] = both[order][1:] != both[order][:-1]
            kept, rest = np.sort(order[first]), order[~first]
            repeated = _hits(doc[which[rest]], crc[which[rest]], lo[rest], hi[rest])
            passed = _split(repeated, repeated["doc"] % buckets)
            parts = _split(kept, (key[kept] % np.uint64(buckets)).astype(np.int64))
            rows = []
            for b in sorted(parts.keys() | passed.keys()):
                i = parts.get(b, kept[:0])
                rows.append((
                    b, key[i].tobytes(), run[i].tobytes(), doc[which[i]].tobytes(), crc[which[i]].astype("<u4").tobytes(),
                    lo[i].astype("<u4").tobytes(), (hi[i] - lo[i]).astype("u1").tobytes(), passed.get(b, repeated[:0]).tobytes(),
                ))
            names = [f.split()[0] for f in RUN_MESSAGE.split(", ")]
            types = [pa.int32()] + [pa.binary()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return emit


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), dtype)


DEAL = (2_147_483_647, 1_103_515_245, 69_069, 2_147_483_629)  # two primes and two factors; no sum exceeds 63 bits


def _part_of(doc: np.ndarray, crc: np.ndarray, parts: int) -> np.ndarray:
    """The part of rows, from id and CRC-32, so that ids in steps and rows without an id spread as well."""
    p, a, b, q = DEAL
    return (doc % p * a + crc.astype(np.int64) * b) % q % parts


def _part_column(parts: int) -> Column:
    """``_part_of`` as an expression."""
    p, a, b, q = (F.lit(v).cast("long") for v in DEAL)
    return (F.pmod(F.pmod(F.coalesce("doc", F.lit(int(NO_ID))), p) * a + F.col("crc") * b, q) % F.lit(parts)).cast("int")


def _doc_messages(hits: np.ndarray, asks: np.ndarray, parts: int) -> pa.Table:
    by_hit, by_ask = (_split(m, _part_of(m["doc"], m["crc"], parts)) for m in (hits, asks))
    names = sorted(by_hit.keys() | by_ask.keys())
    return pa.table({
        "part": pa.array(names, pa.int32()),
        "hits": pa.array([by_hit.get(p, hits[:0]).tobytes() for p in names], pa.binary()),
        "asks": pa.array([by_ask.get(p, asks[:0]).tobytes() for p in names], pa.binary()),
    })


def _meet(parts: int):
    def meet(table: pa.Table) -> pa.Table:
        key, run = _joined(table, "key", "<u8"), _joined(table, "run", "<u8")
        doc, crc = _joined(table, "doc", "<i8"), _joined(table, "crc", "<u4").astype(np.int64)
        lo, span = _joined(table, "lo", "<u4").astype(np.int64), _joined(table, "span", "u1").astype(np.int64)
        both = mix(key + mix(run))
        order = np.lexsort((lo, crc, doc, both))
        head = np.ones(len(order), bool)
        head[1:] = both[order][1:] != both[order][:-1]
        twin = np.zeros(len(order), bool)  # the same occurrence once more
        twin[1:] = ~head[1:] & (doc[order][1:] == doc[order][:-1]) & (crc[order][1:] == crc[order][:-1]) & (lo[order][1:] == lo[order][:-1])
        group = np.cumsum(head) - 1
        firsts = order[head]
        of = firsts[group]
        twin |= (doc[order] == doc[of]) & (crc[order] == crc[of]) & (lo[order] == lo[of])
        rest = order[~head & ~twin]
        given = _joined(table, "hits", HIT)
        hits = _hits(
            np.concatenate([doc[rest], given["doc"]]), np.concatenate([crc[rest], given["crc"].astype(np.int64)]),
            np.concatenate([lo[rest], given["lo"].astype(np.int64)]), np.concatenate([(lo + span)[rest], given["hi"].astype(np.int64)]),
        )
        _, name, count = np.unique(key[firsts], return_inverse=True, return_counts=True)
        open_runs = firsts[count[name] > 1]
        asks = np.empty(len(open_runs), ASK)
        for field, values in (("doc", doc), ("crc", crc), ("lo", lo), ("span", span), ("key", key)):
            asks[field] = values[open_runs]
        return _doc_messages(hits, asks, parts)

    return meet


def _fetch(width: int, buckets: int):
    def fetch(docs: pa.Table, messages: pa.Table) -> pa.Table:
        asks = np.sort(_joined(messages, "asks", ASK), order=["doc", "crc", "lo"])
        doc, crc, texts = _columns(docs)
        where = {(d, c): i for i, (d, c) in enumerate(zip(doc.tolist(), crc.tolist()))}
        refs: dict[int, list] = {}
        held: dict[int, list[bytes]] = {}
        for d, c, lo, span, key in asks.tolist():
            text = texts[where[d, c]]
            refs.setdefault(key % buckets, []).append((d, c, lo, span + width))
            held.setdefault(key % buckets, []).append(text[lo : lo + span + width])
        names = sorted(refs)
        return pa.table({
            "bucket": pa.array(names, pa.int32()),
            "refs": pa.array([np.array(refs[b], REF).tobytes() for b in names], pa.binary()),
            "bytes": pa.array([b"".join(held[b]) for b in names], pa.binary()),
        })

    return fetch


_TOKEN_END = np.zeros((256, 256), bool)  # (byte, next byte): white space after about half of the other bytes
for _space in (9, 10, 13, 32):
    _TOKEN_END[:, _space] = ((np.arange(256) * 167) >> 4) & 1
for _space in (9, 10, 13, 32):
    _TOKEN_END[_space] = False


def _classes(shared: np.ndarray, rank: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """For each suffix rank, the first rank of those that share ``depth`` bytes with it."""
    out = np.zeros(len(rank), np.int64)
    order = np.argsort(depth, kind="stable")
    names, heads = np.unique(depth[order], return_index=True)
    places = np.arange(len(shared))
    for d, chosen in zip(names.tolist(), np.split(order, heads[1:])):
        if d > 0:
            out[chosen] = np.maximum.accumulate(np.where(shared < d, places, 0))[rank[chosen]]
    return out


def repeated_windows(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Starts of windows that repeat an earlier window; texts lie end to end in order of precedence."""
    n = len(data)
    cut = np.zeros(n + 1, bool)  # a token starts here
    cut[2:n] = _TOKEN_END[data[:-2], data[1:-1]] if n > 2 else False
    edge = np.zeros(n + 2, bool)
    edge[starts] = True
    cut[:n] &= ~edge[:n]
    cut[1:n] &= ~edge[: n - 1]  # both bytes must stand in the same text
    limit = np.repeat(ends, ends - starts)
    window = np.flatnonzero(np.arange(n) + width <= limit)
    token = np.flatnonzero(cut)
    following = np.searchsorted(token, window + 2)
    next_cut = np.append(token, n + width * 2)[following]
    inside = next_cut < window + width

    key = np.zeros(len(window), np.uint64)
    if inside.any():
        stop = np.minimum(np.append(token[1:], n), limit[token])
        raw = data.tobytes()
        names = [raw[a:b] for a, b in zip(token.tolist(), stop.tolist())]
        order = {name: i + 1 for i, name in enumerate(sorted(set(names)))}
        ended = np.ones(len(token), np.int64)  # a text ends behind this token; its end sorts lowest
        ended[:-1] = limit[token[1:]] != limit[token[:-1]]
        spot = np.arange(len(token)) + np.cumsum(ended) - ended
        symbols = np.zeros(len(token) + int(ended.sum()), np.int64)
        symbols[spot] = [order[x] for x in names]
        begin, stop = np.empty((2, len(symbols)), np.int64)
        begin[spot], stop[spot] = token, limit[token]
        tail = np.flatnonzero(symbols == 0)
        begin[tail] = stop[tail] = limit[token[ended == 1]]
        array = suffix_array(symbols)
        shared = common_prefixes(data, begin, stop, array, width)
        rank = np.empty(len(array), np.int64)
        rank[array] = np.arange(len(array))
        rank = rank[spot]
        w, nxt = window[inside], following[inside]
        head = next_cut[inside] - w
        group = _classes(shared, rank[nxt], width - head)
        key[inside] = mix(_tail_hash(data, w, head) + mix((group * 128 + head).astype(np.uint64)))
    if not inside.all():  # windows without any token start: sorted by bytes
        w = window[~inside]
        fresh = np.ones(len(w), bool)
        fresh[1:] = w[1:] != w[:-1] + 1
        heads = np.flatnonzero(fresh)
        a = w[heads]
        b = w[np.append(heads[1:], len(w)) - 1] + width
        place = np.concatenate([np.append(np.arange(x, y), -1) for x, y in zip(a.tolist(), b.tolist())])
        array = suffix_array(np.where(place >= 0, data[place].astype(np.int64) + 1, 0))
        end_of = np.repeat(b, b - a + 1)
        where = np.where(place >= 0, place, end_of)
        shared = common_prefixes(data, where, end_of, array, width)
        rank = np.empty(len(array), np.int64)
        rank[array] = np.arange(len(array))
        spot = np.full(n + 1, -1, np.int64)
        spot[where[place >= 0]] = np.flatnonzero(place >= 0)
        group = _classes(shared, rank[spot[w]], np.full(len(w), width))
        key[~inside] = mix(group.astype(np.uint64) + np.uint64(1 << 62))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(order), bool)
    again[1:] = key[order][1:] == key[order][:-1]
    return np.sort(window[order[again]])


def _tail_hash(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of the ``size`` bytes at each place."""
    base = 0x9E3779B97F4A7C15
    n = len(data)
    up = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
    down = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)]))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix((total[at + size] - total[at]) * down[at])


def _sort_segments(width: int, parts: int):
    def sort_segments(table: pa.Table) -> pa.Table:
        refs, data = _joined(table, "refs", REF), _joined(table, "bytes", "u1")
        size = refs["size"].astype(np.int64)
        begin = np.cumsum(size) - size
        order = np.lexsort((refs["lo"], refs["crc"], refs["doc"]))
        refs, size, begin = refs[order], size[order], begin[order]
        ends = np.cumsum(size)
        starts = ends - size
        data = data[np.arange(len(data)) - np.repeat(starts - begin, size)]
        found = repeated_windows(data, starts, ends, width)
        of = np.searchsorted(ends, found, side="right")
        at = refs["lo"][of].astype(np.int64) + found - starts[of]
        hits = _hits(refs["doc"][of], refs["crc"][of].astype(np.int64), at, at)
        return _doc_messages(hits, np.zeros(0, ASK), parts)

    return sort_segments


def _apply(width: int):
    def apply(docs: pa.Table, messages: pa.Table) -> pa.Table:
        hits = _joined(messages, "hits", HIT)
        hits = _hits(hits["doc"], hits["crc"].astype(np.int64), hits["lo"].astype(np.int64), hits["hi"].astype(np.int64))
        doc, crc, texts = _columns(docs)
        spans: dict[tuple[int, int], list[list[int]]] = {}
        for d, c, lo, hi in hits.tolist():
            mine = spans.setdefault((d, c), [])
            if mine and lo <= mine[-1][1]:
                mine[-1][1] = max(mine[-1][1], hi + width)
            else:
                mine.append([lo, hi + width])
        kept, cuts = [], []
        for d, c, text in zip(doc.tolist(), crc.tolist(), texts):
            mine = spans.get((d, c), [])
            edges = [0, *(x for span in mine for x in span), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if mine else text)
            cuts.append([{"begin": a, "end": b} for a, b in mine])
        return pa.table({
            "doc_id": docs.column("doc"),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "kept": pa.array(kept, pa.binary()),
            "removed": pa.array(cuts, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
        })

    return apply


def drop_repeats(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 100, part_bytes: int = PART_BYTES
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_bytes, kept (the bytes that are left), removed (spans)."""
    if not 64 <= width <= 255:
        raise ValueError("windows of 64 to 255 bytes")
    docs = df.select(F.col(id_col).cast("long").alias("doc"), payload(text_col).alias("text"))
    parts = parts_for(docs, "text", part_bytes, 12)
    hot = hot_anchors(docs, width)
    keyed = docs.select("doc", F.crc32("text").alias("crc"), "text")
    met = cut_lineage(
        keyed.mapInArrow(_emit_runs(width, parts, hot), RUN_MESSAGE)
        .repartition(parts, "bucket").groupBy("bucket").applyInArrow(_meet(parts), DOC_MESSAGE)
    )
    placed = keyed.select(_part_column(parts).alias("part"), "doc", "crc", "text").repartition(parts, "part")
    segments = (
        placed.groupBy("part").cogroup(met.where(F.length("asks") > 0).select("part", "asks").groupBy("part"))
        .applyInArrow(_fetch(width, parts), SEGMENT_MESSAGE)
        .repartition(parts, "bucket").groupBy("bucket").applyInArrow(_sort_segments(width, parts), HIT_MESSAGE)
    )
    hits = met.select("part", "hits").union(segments.select("part", "hits"))
    return placed.groupBy("part").cogroup(hits.groupBy("part")).applyInArrow(
        _apply(width), "doc_id long, n_bytes long, kept binary, removed array<struct<begin:long,end:long>>"
    )
