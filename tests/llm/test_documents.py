"""Sharding, decontamination, exact and near duplicates, quality, licences, and the pipeline."""

import bisect
import gc
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corridor_metrics.llm import byte_cnn, exact_dedup, licences, ring, simhash, wu_manber
from corridor_metrics.llm.queries import QUERIES
from edge_cases import edges, nothing, shipped  # noqa: F401


def fold(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def listed(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# sharding


def check_shards(rows, placed, shards):
    assert sorted(((p.doc_id, p.size, p.text_crc32) for p in placed), key=repr) == sorted(
        ((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows), key=repr
    )
    slots = defaultdict(list)
    for p in placed:
        slots[p.shard].append(p.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards(spark, edges, nothing, small):
    check_shards(pairs(edges), ring.shard_rows(edges, 5).collect(), 5)
    check_shards(pairs(edges), ring.shard_rows(edges, 40).collect(), 40)
    assert ring.shard_rows(nothing, 4).count() == 0
    docs = spark.read.parquet(f"{small}/documents.parquet")
    placed = QUERIES["op4_ring_shards"](spark, small).collect()
    check_shards(pairs(docs), placed, 40)
    assert {(p.law, p.grown_shard) for p in placed} == {("rows", None)}


def sequential_ring(rows, shards):
    """One row after the other: its own shard if there is room, later the next one clockwise that has some."""
    wheel = ring.Ring.build(shards)
    points, owners = wheel.points.tolist(), wheel.owners.tolist()
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    used, placed, over = [0] * shards, [], []
    keyed = [(bisect.bisect_left(points, r.position % 2**64) % len(points), r.position, r.doc_id, zlib.crc32(r.text.encode()), len(r.text.encode()) + 16) for r in rows]

    def put(row, shard):
        placed.append((row[2], row[4], row[3], owners[row[0]], shard, used[shard]))
        used[shard] += 1

    for row in sorted(keyed):
        home = owners[row[0]]
        if used[home] < room[home]:
            put(row, home)
        else:
            over.append(row)
    for row in over:
        at = row[0]
        while used[owners[at]] >= room[owners[at]]:
            at = (at + 1) % len(points)
        put(row, owners[at])
    return sorted(placed)


def test_placement_against_a_sequential_ring(spark):
    """Every row's shard and slot, and how few rows move when a shard is added."""
    df = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id % 1000) AS text")
    rows = df.selectExpr("*", "xxhash64(doc_id, 'ring') AS position").collect()
    shard = {}
    for shards in (40, 41):
        got = sorted(tuple(r) for r in ring.shard_rows(df, shards).collect())
        assert got == sequential_ring(rows, shards)
        shard[shards] = {r[0]: r[4] for r in got}
    moved = [d for d, s in shard[40].items() if shard[41][d] != s]
    assert len(moved) < 0.15 * len(rows) and sum(shard[41][d] != 40 for d in moved) < 0.12 * len(rows)


def test_ring_moves_only_the_overflow(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    placed = ring.shard_rows(df, 10).collect()
    moved = sum(p.home != p.shard for p in placed)
    natural = Counter(p.home for p in placed)
    assert moved == sum(max(0, n - 400) for n in natural.values()) < 800
    grown = {p.doc_id: p.home for p in ring.shard_rows(df, 11).collect()}
    assert all(grown[p.doc_id] in (p.home, 10) for p in placed)


def test_one_id_in_most_rows(spark):
    df = spark.range(600).selectExpr("if(id < 400, 7, id) AS doc_id", "if(id < 200, 'same', cast(id AS string)) AS text")
    check_shards(pairs(df), ring.shard_rows(df, 7).collect(), 7)


# decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, width=10):
    windows = defaultdict(set)
    for name, text in items:
        words = WORD.findall(fold(text))
        size = min(width, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i : i + size])].add(str(name))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in rows:
        words = WORD.findall(fold(text))
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def test_decontamination_query(spark, small):
    docs, items = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = contamination(pairs(docs), [(r.item_id, r.text) for r in items.collect()])
    assert any(w[5] for w in want)
    assert listed(QUERIES["op6_decontamination"](spark, small)) == want


def test_decontamination_edges(spark, edges, nothing):
    items = [(1, "hello"), (2, "HELLO, world!"), (3, None), (4, ""), (5, "--"), (10, "he he he he he he he he he he he he"), (11, "wizards quietly mix"), (11, "x")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = contamination(pairs(edges), items)
    report = lambda df, **k: listed(wu_manber.contamination_report(wu_manber.find_contamination(df, bench, **k)))
    assert report(edges) == want
    assert report(edges, block_bytes=12) == want
    assert report(nothing) == []
    flags = listed(edges.select("doc_id", wu_manber.contaminated(edges.text, bench, block_bytes=12).alias("c")))
    assert flags == sorted(((w[0], w[5]) for w in want), key=repr)
    assert not any(r[5] for r in listed(wu_manber.contamination_report(wu_manber.find_contamination(edges, bench.where("false")))))


def test_one_table_at_a_time(spark, edges):
    items = [(i, " ".join(f"w{(i * 7 + k) % 400}" for k in range(25))) for i in range(300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    patterns = wu_manber.store_patterns(bench, "item_id", "text", 10, 500)
    assert patterns.blocks > 40
    seen = {}
    for turn in range(3):
        numbers = []
        for tables in patterns:
            numbers.append(patterns.number)
            assert [o for o in gc.get_objects() if type(o) is wu_manber.WindowSearch] == [tables]
            for window, names in tables.owners.items():
                seen.setdefault(window, set()).update(names)
        assert sorted(numbers) == list(range(patterns.blocks)) and (turn == 0 or numbers[0] == last)  # noqa: F821
        last = numbers[-1]  # noqa: F841
    assert seen == wu_manber.WindowSearch([(str(i), t.encode()) for i, t in items]).owners
    docs = spark.createDataFrame([(1, items[3][1] + " x " + items[8][1]), (2, "nothing"), (3, items[299][1])], "doc_id long, text string")
    got = listed(wu_manber.contamination_report(wu_manber.find_contamination(docs, bench, block_bytes=500)))
    assert got == contamination(pairs(docs), items)


def test_search_against_all_positions():
    rng = random.Random(2)
    for _ in range(200):
        items = [(str(i), " ".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))) for i in range(4)]
        words = [rng.choice("abcd") for _ in range(30)]
        search = wu_manber.WindowSearch([(n, t.encode()) for n, t in items], 4)
        got = {(i, w) for i, w in search.find([w.encode() for w in words])}
        want = {(i, w) for w in search.owners for i in range(len(words) - len(w) + 1) if tuple(x.encode() for x in words[i : i + len(w)]) == w}
        assert got == want


# exact duplicates


def equal_groups(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[fold(text)].append(doc)
    out, kept = [], set()
    for doc, text in rows:
        ids = groups[fold(text)]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        stays = doc == keep and (fold(text), keep) not in kept
        if stays:
            kept.add((fold(text), keep))
        out.append((doc, keep, len(ids), stays, hashlib.sha256(fold(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_edges(edges, nothing):
    assert listed(exact_dedup.duplicate_groups(edges)) == equal_groups(pairs(edges))
    assert exact_dedup.duplicate_groups(nothing).count() == 0


def test_fingerprints_compose():
    data = bytes(random.Random(1).randbytes(200_000))
    whole = exact_dedup.fingerprint(data)
    for cut in (0, 1, 65_536, 131_073, len(data)):
        joined = exact_dedup.fingerprint(data[:cut]) + exact_dedup.fingerprint(data[cut:])
        assert (joined.values, joined.size) == (whole.values, whole.size)


def test_chunks_of_one_text_are_combined_over_tasks(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcXYZ é", k=n)) for n in (1, 65_535, 65_536, 400_000, 1_300_000)]
    rows = [*enumerate(texts), (3, texts[3]), (3, texts[4]), (None, texts[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "CAST(text AS BINARY) AS text")
    got = exact_dedup.long_prints(df)
    want = []
    for doc, text in rows:
        data = fold(text).encode()
        value = exact_dedup.fingerprint(data)
        want.append((doc, value.size, *value.values, hashlib.sha256(data).hexdigest()))
    assert listed(got) == sorted(want, key=repr)
    pieces = exact_dedup.chunk_rows(df.where("doc_id = 4"))
    assert pieces.count() == -(-len(texts[4].encode()) // exact_dedup.CHUNK)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert pieces.select(F.spark_partition_id()).distinct().count() > 3
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert listed(exact_dedup.fingerprints(df)) == listed(got)
    assert exact_dedup.long_prints(df.limit(0)).count() == 0


def test_long_texts_are_grouped(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LONG", 10)
    df = spark.createDataFrame(
        [(1, "A" * 70_000), (2, "a" * 70_000), (2, "a" * 70_000), (None, "a" * 70_000), (3, "a" * 70_001), (4, "short"), (5, None), (6, "SHORT")],
        "doc_id long, text string",
    )
    assert listed(exact_dedup.duplicate_groups(df)) == equal_groups(pairs(df))


def test_equal_fingerprints_are_compared(spark, monkeypatch):
    df = spark.createDataFrame([(1, "aaa"), (2, "AAA"), (3, "bbb"), (4, "ccc")], "doc_id long, text string")
    real = exact_dedup.fingerprints
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda *a: real(*a).selectExpr("doc_id", "n_bytes", "1L AS print_a", "1L AS print_b", "text_sha256"))
    assert listed(exact_dedup.duplicate_groups(df), "doc_id", "keep_id", "group_size", "kept") == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True)]


def test_equal_fingerprints_without_ids_are_compared(spark, monkeypatch):
    df = spark.createDataFrame([(None, "aaa"), (None, "AAA"), (None, "bbb"), (4, "ccc"), (None, "dddd")], "doc_id long, text string")
    real = exact_dedup.fingerprints
    monkeypatch.setattr(exact_dedup, "fingerprints", lambda *a: real(*a).selectExpr("doc_id", "n_bytes", "1L AS print_a", "1L AS print_b", "text_sha256"))
    few = df.where("doc_id IS NULL")
    assert exact_dedup.unequal_groups(few, exact_dedup.fingerprints(few)).count() == 1
    assert listed(exact_dedup.duplicate_groups(df)) == equal_groups(pairs(df))


# near duplicates


def near_groups(rows):
    prints = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes)))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[root(i)] += [doc] if doc is not None else []
    return sorted(((doc, f"{prints[i]:016x}", min(least[root(i)], default=None)) for i, (doc, _) in enumerate(rows)), key=repr)


def near_rows(df, **sizes):
    return listed(simhash.near_duplicates(df, **sizes).select("doc_id", simhash.hex_print("print"), "component_id"))


def test_simhash_edges(edges, nothing):
    rows = [(d, t) for d, t in pairs(edges)]
    assert near_rows(edges) == near_groups(rows)
    assert near_rows(nothing) == []


def test_simhash_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert listed(QUERIES["op10_simhash"](spark, small)) == near_groups(pairs(docs))


@pytest.mark.parametrize("bucket", [20_000, 15])
def test_links_in_chains_and_crowds(spark, bucket):
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for start in list(prints)[:3]:
        x = start
        for _ in range(60):
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "doc_id long, print long")
    roots = {r.node: r.root for r in simhash.components(simhash.close_links(df, 3, bucket)).collect()}
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[root(i)] = root(j)
    groups = defaultdict(set)
    for i, s in enumerate(signed):
        groups[root(i)].add(s)
    got = defaultdict(set)
    for s in signed:
        got[roots.get(s, s)].add(s)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))
    assert all(r == min(g) for r, g in got.items())


@pytest.mark.parametrize("n", [10, 10**6, 10**9, 10**11, 10**16])
def test_masks_leave_a_shared_key(n):
    masks = simhash.block_masks(n)
    rng = random.Random(n)
    for _ in range(300):
        odd = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(odd & m == 0 for m in masks)


# quality


def test_quality_edges_and_held_out_rows(spark, edges, nothing, small):
    folder = small.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = byte_cnn.train(docs, labels)
    texts = [t.encode() if t else b"" for _, t in pairs(edges)]
    scores = model.scores(texts)
    assert ((scores >= 0) & (scores <= 1)).all()
    for text, score in zip(texts, scores):  # however texts are batched
        assert abs(model.scores([text])[0] - score) < 1e-5
    assert edges.select(byte_cnn.score(model, edges.text)).count() == len(texts)
    assert byte_cnn.quality(nothing, labels).count() == 0
    assert {r.score for r in byte_cnn.quality(edges, labels.where("false")).collect()} == {0.5}
    scored = QUERIES["op9_quality_cnn"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    right = np.mean([r.predicted == r.quality for r in scored])
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert right > 0.93
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_gradients():
    settings = byte_cnn.Settings(embedding=2, width=3, stride=2, filters=3, chunk=16, step=12)
    model = byte_cnn.ByteCNN(settings)
    for name in ("embed", "weight", "bias", "out", "prior"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.bias[:] = (0.4, -0.1, 0.2)  # away from the kink of the rectifier, where windows of padding respond 0
    rows = [model.chunks(t) for t in (b"some words here", b"zz" * 30, b"")]
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        p = []
        for r in rows:
            f = model.pooled(r)
            p.append(model._probability(np.concatenate([f.mean(axis=0), f.max(axis=0)])[None])[0])
        p = np.array(p)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)) + 5e-5 * (model.out**2).sum()

    gradients = model._gradients(rows, labels)
    shown = np.unique(np.concatenate([r.reshape(-1) for r in rows]))
    for value, gradient in zip((model.embed, model.weight, model.bias, model.out, model.prior), gradients):
        spots = [(int(b), e) for b in shown for e in range(2)] if value is model.embed else list(np.ndindex(value.shape))
        for spot in spots:
            old = value[spot]
            value[spot] = old + 1e-5
            up = loss()
            value[spot] = old - 1e-5
            down = loss()
            value[spot] = old
            assert abs((up - down) / 2e-5 - gradient[spot]) < 1e-3


def test_scores_against_a_plain_forward_pass():
    settings = byte_cnn.Settings(embedding=3, width=4, stride=2, filters=5, chunk=16, step=12)
    model = byte_cnn.ByteCNN(settings)
    rng = np.random.default_rng(3)
    model.bias[:] = rng.normal(0, 0.3, 5)
    model.prior[0] = 0.2
    texts = [b"", b"a", b"sixteen bytes ok", b"seventeen bytes !", b"some words here, more than one chunk of them", bytes(range(256)) * 30]

    def plain(text):
        starts = [0]
        while starts[-1] + settings.chunk < len(text):
            starts.append(starts[-1] + settings.step)
        pooled = []
        for start in starts:
            piece = list(text[start : start + settings.chunk])
            piece += [byte_cnn.PAD] * (settings.chunk - len(piece))
            windows = [piece[at : at + settings.width] for at in range(0, settings.chunk - settings.width + 1, settings.stride)]
            answers = [[sum(x * w for x, w in zip(np.concatenate([model.embed[b] for b in window]), model.weight[:, f])) for window in windows] for f in range(5)]
            pooled.append([max(0.0, max(a) + model.bias[f]) for f, a in enumerate(answers)])
        means = [sum(p[f] for p in pooled) / len(pooled) for f in range(5)]
        most = [max(p[f] for p in pooled) for f in range(5)]
        return 1 / (1 + np.exp(-(sum(x * w for x, w in zip(means + most, model.out)) + model.prior[0])))

    assert np.allclose(model.scores(texts), [plain(t) for t in texts], atol=1e-5)


# licences


def test_best_template_against_a_plain_cosine():
    rng = random.Random(5)
    templates = licences.all_templates(licences.NOTICES)
    terms = sorted({t for _, text in templates for t in wu_manber.words_of(text.encode())})
    total = 500
    frequency = {t: rng.choice([0, 1, 5, 80, total]) for t in terms}
    matcher = licences.NoticeMatcher(templates, frequency, total)

    def vector(words):
        return {t: n * (np.log((1 + total) / (1 + frequency.get(t, 0))) + 1) for t, n in Counter(words).items()}

    def cosine(a, b):
        return sum(w * b.get(t, 0) for t, w in a.items()) / np.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))

    vectors = [(name, vector(wu_manber.words_of(text.encode()))) for name, text in templates]
    for k in range(120):
        words = wu_manber.words_of(rng.choice(templates)[1].encode())[: rng.choice([1, 8, 40, 10_000])] if k % 3 else rng.choices(terms, k=rng.randint(1, 30))
        words = words + rng.choices([b"cars", b"north", b"week"], k=rng.randint(0, 12))
        own = vector(words)
        scores = [(cosine(own, v), name) for name, v in vectors]
        score, name = matcher.best(words)
        assert abs(score - max(scores)[0]) < 1e-9
        assert any(n == name and abs(s - score) < 1e-9 for s, n in scores)
    assert matcher.best([b"cars"]) == (0.0, None)


def test_notice_in_a_very_long_text():
    templates = licences.all_templates(licences.NOTICES)
    matcher = licences.NoticeMatcher(templates, {t: 1 for _, text in templates for t in wu_manber.words_of(text.encode())}, 9)
    line = "the counts of the week were taken at the north gate\n" * 20_000
    score, name = matcher.notice((line + licences.NOTICES["MPL-2.0"] + "\n" + line).encode())
    assert name == "MPL-2.0" and score > 0.999


def test_licences_inherit_from_the_nearest_folder(spark):
    mit, apache = licences.NOTICES["MIT"], licences.NOTICES["Apache-2.0"]
    rows = [
        (1, "LICENSE", mit), (2, "a/x.txt", "some text"), (3, "a/b/LICENSE", "Preamble\n" + apache + "\n"), (4, "a/b/y.txt", "more\nof it"),
        (5, "a/b/c/d/z.txt", None), (6, "a/b/c/w.txt", "Body text.\n" + licences.NOTICES["GPL-3.0"]), (7, None, "nowhere"), (8, None, mit),
        (9, "a/b/c/w.txt", ""), (9, "a/b/c/w.txt", ""), (10, "q/COPYING", "not one"), (11, "q/t", "plain"), (None, "top.txt", "plain"),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, path string, text string, own string, score int")
    got = {r.doc_id: (r.licence, r.origin, r.licence_path) for r in licences.scan_licences(df).collect()}
    assert got == {
        1: ("MIT", "file", "LICENSE"), 2: ("MIT", "inherited", "LICENSE"), 3: ("Apache-2.0", "file", "a/b/LICENSE"),
        4: ("Apache-2.0", "inherited", "a/b/LICENSE"), 5: ("Apache-2.0", "inherited", "a/b/LICENSE"), 6: ("GPL-3.0", "notice", "a/b/c/w.txt"),
        7: (None, "none", None), 8: ("MIT", "notice", None), 9: ("Apache-2.0", "inherited", "a/b/LICENSE"), 10: ("MIT", "inherited", "LICENSE"),
        11: ("MIT", "inherited", "LICENSE"), None: ("MIT", "inherited", "LICENSE"),
    }
    assert licences.scan_licences(df).count() == len(rows)
    assert licences.scan_licences(df.where("false")).count() == 0


def test_licence_query_finds_every_notice(spark, small):
    folder = small.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op2_licence_scan"](spark, folder).collect()}
    assert len(got) == len(docs)
    own = {d: next((n for n, t in sorted(licences.NOTICES.items()) if t in (text or "")), None) for d, text in ((r.doc_id, r.text) for r in docs)}
    assert any(own.values())
    files = {r.path: own[d] for d, r in got.items() if r.path.endswith("LICENSE") and own[d]}
    for d, r in got.items():
        folders = r.path.split("/")[:-1]
        above = next((files[p] for k in range(len(folders), -1, -1) if (p := "/".join([*folders[:k], "LICENSE"])) in files), None)
        assert r.licence == (own[d] or above), (d, r)


def test_licence_texts_and_wrapped_notices(spark):
    from corridor_metrics.llm import licence_templates as lt

    texts = {n: t for n, t in lt.all_templates({}) if len(t) > 5000}
    mit = "MIT License\n\nCopyright (c) 2021 Some Person\n" + lt._MIT.split("Copyright (c)\n")[1]
    bsd = "BSD 3-Clause License\n\nCopyright (c) 2019, A Company\nAll rights reserved.\n" + lt._CLAUSES + "\n3. " + lt._NAMES.strip() + "\n" + lt._DISCLAIMER
    two = "Copyright 2011 B. Author\n" + lt._CLAUSES + lt._DISCLAIMER
    gpl = lt.TEXTS["GPL-3.0"][1].split()
    wrapped = [" ".join(gpl[i : i + 7]) for i in range(0, len(gpl), 7)]
    inside = "This tool counts cars at junctions. " + licences.NOTICES["MPL-2.0"] + " Reports go to the district office every month."
    prose = "The counts of the week were taken at the north gate, and all of the cars that came by in the morning were written down.\n" * 3
    apache = lt.TEXTS["Apache-2.0"][1].split()
    rows = [
        (1, "a/LICENSE", mit, "MIT"), (2, "b/LICENSE", bsd, "BSD-3-Clause"), (3, "c/LICENSE", two, "BSD-2-Clause"), (4, "d/COPYING", texts["GPL-3.0"], "GPL-3.0"),
        (5, "e/COPYING", texts["GPL-2.0"], "GPL-2.0"), (6, "f/COPYING", texts["LGPL-2.1"], "LGPL-2.1"), (7, "g/LICENSE", texts["Apache-2.0"], "Apache-2.0"),
        (8, "h/x.py", "#!/bin/x\n" + "".join(f"# {w}\n" for w in wrapped) + "import os\nfrom sys import argv\nprint(argv)\n" * 5, "GPL-3.0"),
        (9, "i/x.c", "/* A counter.\n\n" + "\n".join(" ".join(apache[i : i + 6]) for i in range(0, len(apache), 6)) + "\n*/\nint main(void) { return count(1); }\n", "Apache-2.0"),
        (10, "j/x.md", inside, "MPL-2.0"), (11, "k/x.md", prose + inside.replace("Form is", "Form\nis") + "\n" + prose, "MPL-2.0"),
        (12, "l/README", prose + "\n" + mit + "\n" + prose, "MIT"), (13, "m/y.txt", prose, None), (14, "n/y.txt", "He was given permission to sell the licence.\n" + prose, None),
        (15, "o/x.c", "/*\n" + bsd + "*/\nint x;\n" * 30, "BSD-3-Clause"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "doc_id long, path string, text string")
    got = {r.doc_id: r.licence for r in licences.scan_licences(df).collect()}
    assert got == {r[0]: r[3] for r in rows}


# pipeline


def test_pipeline_against_brute_force(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier"
    stages, current = [], docs
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, current, small)
        current = spark.createDataFrame(kept.collect(), kept.schema)
        stages.append(current)
    assert all(s.columns == docs.columns for s in stages[:-1])
    scores = byte_cnn.score(byte_cnn.train(docs, spark.read.parquet(f"{small}/labels.parquet")), docs.text)
    kept = {r.doc_id for r in docs.select("doc_id", scores.alias("s")).collect() if r.s >= 0.3}
    assert {r.doc_id for r in stages[0].collect()} == kept and kept
    want = {g[0] for g in equal_groups(pairs(stages[0])) if g[3]}
    assert [r.doc_id for r in stages[1].orderBy("doc_id").collect()] == sorted(want)
    want = {g[0] for g in near_groups(pairs(stages[1])) if g[0] == g[2]}
    assert [r.doc_id for r in stages[2].orderBy("doc_id").collect()] == sorted(want)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    want = {c[0] for c in contamination(pairs(stages[2]), items) if not c[5]}
    assert [r.doc_id for r in stages[3].orderBy("doc_id").collect()] == sorted(want)
    assert listed(QUERIES.get("pipeline", corpus_pipeline.run)(spark, small)) == listed(stages[4])


def test_near_dedup_leaves_one_row_of_each_component(spark, edges):
    import corpus_pipeline

    other = [(None, "nothing in common with the rest of these rows"), (None, "a second text without any id at all, on its own"), (20, "same id"), (20, "yet unlike words")]
    docs = edges.select("doc_id", "text").union(spark.createDataFrame(other, "doc_id long, text string"))
    docs = docs.selectExpr("*", "'en' AS lang", "cast(null AS string) AS source", "cast(null AS long) AS n_chars")
    rows = pairs(docs)
    found = simhash.near_duplicates(docs.selectExpr("*", "sha2(coalesce(text, ''), 256) AS digest"), carried=("digest",)).collect()
    assert len(found) == len(rows)
    groups = defaultdict(set)
    for r in found:
        groups[r.root].add((r.doc_id is None, r.doc_id or 0, r.digest))
    want = sorted(min(g) for g in groups.values())
    assert sum(w[0] for w in want) > 1 and len({w[:2] for w in want}) < len(want)
    kept = pairs(corpus_pipeline.simhash_stage(spark, docs, ""))
    assert sorted((d is None, d or 0, hashlib.sha256((t or "").encode()).hexdigest()) for d, t in kept) == want


def test_pipeline_stages_take_edges(spark, edges, small):
    import corpus_pipeline

    docs = edges.selectExpr("doc_id", "text", "lang", "cast(null AS string) AS source", "cast(null AS long) AS n_chars", "1 AS _id", "'x' AS _text_key")
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, small).collect()
        assert stage(spark, docs.where("false"), small).isEmpty()
        if name == "exact dedup":
            assert sorted((r.doc_id for r in rows), key=repr) == sorted((g[0] for g in equal_groups(pairs(docs)) if g[3]), key=repr)
