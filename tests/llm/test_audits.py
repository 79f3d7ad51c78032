"""Periodic runs, secrets and the audit of filters, each against a plain version."""

import base64
import hashlib
import json
import random
import re
import struct
import zlib
from collections import Counter
from fractions import Fraction
from itertools import permutations
from math import factorial

import numpy as np
import pytest

from corridor_metrics.llm import filter_audit, secrets, word_runs
from corridor_metrics.llm.queries import QUERIES, planted_runs
from edge_cases import edges, nothing, shipped  # noqa: F401

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def listed(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# periodic runs


def plain_runs(words, min_length=6, min_power=4):
    """Every distance on its own: stretches of equal words that far apart, without a smaller period."""
    numbers = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words], np.int64)
    n, found = len(w), []
    for q in range(1, n // min_power + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for lo, hi in zip(edges[::2], edges[1::2]):
            start, length = int(lo), int(hi - lo) + q
            if length < max(min_length, min_power * q):
                continue
            part = w[start : start + length]
            if not any(q % p == 0 and (part[p:] == part[:-p]).all() for p in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def report(doc, text, runs=plain_runs):
    words = SPACES.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_automaton_against_all_distances():
    rng = random.Random(5)
    for _ in range(1500):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, 12)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert word_runs.runs_of(words) == plain_runs(words)
        assert word_runs.runs_of(words, 2, 2) == plain_runs(words, 2, 2)


def test_stretches_hold_all_runs():
    rng = random.Random(6)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(0, 6)):
            n, k = rng.randint(0, 90), rng.choice([1, 2, 3, 40])
            words = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, 20)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        assert word_runs.runs_of_texts(texts) == [plain_runs(t) for t in texts]
        assert word_runs.runs_of_texts(texts, 2, 2) == [plain_runs(t, 2, 2) for t in texts]


def test_fibonacci_words_and_long_powers():
    a, b = [0], [0, 1]
    while len(b) < 2000:
        a, b = b, b + a
    assert word_runs.runs_of(b, 2, 2) == plain_runs(b, 2, 2)
    rng = random.Random(1)
    unit = [rng.randrange(1000) for _ in range(2500)]
    words = unit * 4 + unit[:7] + [7, 7, 7, 7, 7, 7]
    assert word_runs.runs_of(words) == plain_runs(words)
    path = word_runs.SquareFinder(20000)
    for _ in range(20000):  # a path of 20,000 states must not be walked for each word
        squares = path.append(0)
    assert squares == [(1, 19999)]


def test_runs_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((report(r.doc_id, r.text) for r in docs), key=repr)
    assert sum(w[1] for w in want) > 10
    assert listed(QUERIES["op11_word_runs"](spark, small)) == want


def test_runs_of_edge_rows(spark, edges, nothing):
    got = word_runs.find_runs(edges)
    rows = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    want = []
    for doc, text in rows:
        words = SPACES.findall(text or "")
        numbers = {w: i for i, w in enumerate(sorted(set(words)))}
        runs = word_runs.runs_of([numbers[w] for w in words]) if len(words) > 5000 else plain_runs(words)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        want.append((doc, len(words), [tuple(r) for r in runs], " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert any((0, 300, 1) in w[2] for w in want) and any(w[1] > 100000 and w[2] for w in want)
    assert word_runs.find_runs(nothing).count() == 0
    assert planted_runs(nothing).count() == 0 and planted_runs(edges).count() == len(rows)
    with pytest.raises(ValueError):
        word_runs.find_runs(edges, min_power=1)


# secrets


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else (lambda b: bytes([0x80 | len(b)]) + b)(len(body).to_bytes((len(body).bit_length() + 7) // 8, "big"))
    return bytes([tag]) + size + body


def integer(value):
    return der(2, value.to_bytes(value.bit_length() // 8 + 1, "big"))


def material():
    rng = random.Random(9)
    big = [integer(rng.getrandbits(510) | 1 << 509) for _ in range(8)]
    rsa = der(0x30, integer(0), *big)
    dsa = der(0x30, integer(0), *big[:5])
    curve = der(6, bytes.fromhex("2a8648ce3d030107"))
    ec = der(0x30, integer(1), der(4, rng.randbytes(32)), der(0xA0, curve), der(0xA1, der(3, b"\0\4" + rng.randbytes(64))))
    rsa_id = der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), der(5))
    pkcs8 = der(0x30, integer(0), rsa_id, der(4, rsa))
    ed25519 = der(0x30, integer(0), der(0x30, der(6, bytes.fromhex("2b6570"))), der(4, der(4, rng.randbytes(32))))
    pbes = der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(5)))
    locked = der(0x30, pbes, der(4, rng.randbytes(64)))
    string = lambda b: struct.pack(">I", len(b)) + b
    public = string(string(b"ssh-ed25519") + string(rng.randbytes(32)))
    check = rng.randbytes(4)
    openssh = b"openssh-key-v1\0" + string(b"none") + string(b"none") + string(b"") + struct.pack(">I", 1) + public + string(check * 2 + rng.randbytes(96))
    return {"rsa": rsa, "dsa": dsa, "ec": ec, "pkcs8": pkcs8, "ed25519": ed25519, "locked": locked, "openssh": openssh}


def b64(data):
    return base64.b64encode(data).decode()


def folded(text, width=64, end="\n"):
    return end.join(text[i : i + width] for i in range(0, len(text), width))


def url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def jwt(header, payload, signature):
    return ".".join((url(json.dumps(header).encode()), url(json.dumps(payload).encode()), url(signature)))


def confirmed(text):
    return [s for s in secrets.spans_of(text) if s[0] in ("key", "token")]


@pytest.mark.parametrize("name", material())
def test_keys_in_every_encoding(name):
    key = material()[name]
    at = len("Grüße \U0001f600 ")
    for shown in (b64(key), b64(key).rstrip("="), url(key), folded(b64(key)), folded(b64(key), end="\r\n")):
        assert confirmed(f"Grüße \U0001f600 {shown} and more") == [("key", at, at + len(shown))]
        assert confirmed(f"{shown}\nfollows")[0][:2] == ("key", 0)
    if len(key) >= 32:
        assert confirmed(f'x "{key.hex()}" y {key.hex().upper()}') == [
            ("key", 3, 3 + 2 * len(key)), ("key", 7 + 2 * len(key), 7 + 4 * len(key))]
    armour = f"-----BEGIN PRIVATE KEY-----\n{folded(b64(key))}\n-----END PRIVATE KEY-----"
    assert confirmed(f"a {armour} b") == [("key", 2, 2 + len(armour))]
    assert confirmed(armour.replace("\n", "\\n")) == [("key", 0, len(armour.replace("\n", "\\n")))]  # as in JSON
    twice = b64(armour.encode())
    assert confirmed(f"data: {twice}") == [("key", 6, 6 + len(twice))]
    assert confirmed(f"data: {b64(b64(key).encode())}")[0][:2] == ("key", 6)


@pytest.mark.parametrize("name", material())
def test_damaged_keys_are_not_reported(name):
    key = material()[name]
    rng = random.Random(2)
    assert not confirmed(b64(key[:-1])) and not confirmed(key[:-1].hex())
    assert not confirmed(b64(b"\0" + key)) and not confirmed(b64(rng.randbytes(len(key))))
    assert not secrets.private_key(key[:1] + bytes([key[1] ^ 1]) + key[2:])
    assert not confirmed(f"-----BEGIN PRIVATE KEY-----\n{b64(key[:-9])}\n-----END PRIVATE KEY-----")
    assert not confirmed("-----BEGIN PRIVATE KEY-----\nnothing")
    public = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), der(5)), der(3, b"\0" + der(0x30, integer(1 << 1000), integer(65537))))
    assert not confirmed(b64(public))


def test_tokens():
    claims = {"sub": "1"}
    good = [jwt({"alg": "HS256", "typ": "JWT"}, claims, b"s" * 32), jwt({"typ": "JWT", "alg": "RS256"}, {}, b"r" * 256), jwt({"alg": "ES512"}, claims, b"e" * 132)]
    for token in good:
        assert confirmed(f"Bearer {token}, then") == [("token", 7, 7 + len(token))]
    sealed = ".".join((url(b'{"alg":"dir","enc":"A128GCM"}'), "", url(b"iv"), url(b"text"), url(b"tag")))
    assert confirmed(sealed) == [("token", 0, len(sealed))]
    bad = [
        jwt({"alg": "none"}, claims, b""), jwt({"alg": "HS256"}, claims, b"s" * 31), jwt({"alg": "RS256"}, claims, b"s" * 64),
        jwt({"typ": "JWT"}, claims, b"s" * 32), jwt({"alg": 5}, claims, b"s" * 32), jwt(["alg"], claims, b"s" * 32),
        jwt({"alg": "HS256"}, ["no"], b"s" * 32), f"{url(b'{not json}')}.{url(b'{}')}.{url(b's' * 32)}", sealed.rsplit(".", 1)[0] + ".",
        url(b'{"a":' * 4000) + ".e30." + url(b"s" * 32),
    ]
    for token in bad:
        assert not confirmed(token), token


def plain_secrets(text):
    """The three patterns written out letter by letter."""
    def either(word):
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)

    names = "|".join(either(w) for w in ("password", "passwd", "secret", "token")) + "|" + either("api") + "_?" + either("key")
    kinds = (
        ("assign", rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32),
    )
    found = [(m.start(), k, kind, m.end()) for k, (kind, pattern, fits) in enumerate(kinds) for m in re.finditer(pattern, text) if fits(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def test_plain_patterns():
    texts = [
        "password: hunter2", "PassWd='aaaaaaaa' token==bbbbbbbbb", "api_key=\"x\" apikey=12345678 API KEY=123456789", "ſecret=12345678 toKen=12345678",
        "AKIA" + "A" * 11, "xAKIA" + "B" * 12 + "b", "AKIAAKIA" + "0" * 9, "0" * 31 + "g" + "a" * 32, "secret=" + "f" * 40 + "G", "token=token=abcdefgh", "",
        "passwordpassword = aaaaaaaa", "secret = \t12345678", "secret : '" + "z" * 100, "A" * 32 + "a" * 33,
    ]
    for text in texts:
        assert [s for s in secrets.spans_of(text) if s[0] in secrets.PLAIN] == plain_secrets(text), text


def test_secrets_query(spark, edges, nothing):
    folder = "/root/testdata/sf0.01"  # the smallest table with secrets
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in docs:
        base = plain_secrets(r.text or "")
        count = Counter(s[0] for s in base)
        want.append((r.doc_id, *(count[k] for k in secrets.PLAIN), sha(",".join(f"{k}:{s}:{e}" for k, s, e in base))))
    assert any(w[1] for w in want)
    assert listed(QUERIES["op12_secret_scan"](spark, folder), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=repr)
    keys = "\n".join(b64(k) + " ." for k in material().values())
    rows = [(1, "x " + b64(material()["rsa"])), (1, "x " + b64(material()["rsa"])), (2, None), (None, "password = abcdefgh"), (3, "word " * 300000 + keys)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, spans string, kind int")
    got = {(r.doc_id, tuple(tuple(s) for s in r.spans)) for r in secrets.scan_secrets(df).collect()}
    assert got == {(i, tuple(secrets.spans_of(t or ""))) for i, t in rows}
    assert len(secrets.spans_of(rows[4][1])) == len(material())
    assert secrets.scan_secrets(df).count() == len(rows) and secrets.scan_secrets(nothing).count() == 0
    assert secrets.scan_secrets(edges).count() == edges.count()


# audit of filters


def test_least_squares_gives_shapley_values():
    rng = random.Random(4)
    for n in (1, 2, 3, 5):
        for _ in range(20):
            cells = [(rng.randrange(1 << n), rng.randrange(50)) for _ in range(12)]
            removal = [sum(c for m, c in cells if m & s) for s in range(1 << n)]
            mean = [Fraction(0)] * n
            for order in permutations(range(n)):
                before = 0
                for k in order:
                    mean[k] += Fraction(removal[before | 1 << k] - removal[before], factorial(n))
                    before |= 1 << k
            assert filter_audit.shapley_values(removal, n) == mean


def plain_audit(rows, labels):
    """Every order run filter by filter over all documents."""
    smallest = {}
    for doc, text, _ in rows:
        if doc is not None:
            smallest[text or ""] = min(doc, smallest.get(text or "", doc))
    marks = {"good": {d for d, q, _ in labels if q == 1}, "toxic": {d for d, _, t in labels if t == 1}}
    parts = {}
    for doc, text, part in rows:
        t = text or ""
        words = SPACES.findall(t)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": doc is not None and smallest[t] < doc,
        }
        failed = frozenset(k for k, v in fails.items() if v)
        parts.setdefault(part or "", Counter())[failed, doc is not None and doc in marks["good"], doc is not None and doc in marks["toxic"]] += 1
    out = []
    for part, cells in parts.items():
        found, shares = [], Counter()
        for order in permutations("ABCDE"):
            left = Counter(cells)
            for step, letter in enumerate(order, 1):
                gone = {c: n for c, n in left.items() if letter in c[0]}
                for c in gone:
                    del left[c]
                removed = sum(gone.values())
                shares[letter] += removed
                found.append([
                    part, "".join(order), step, sum(left.values()), removed, sum(n for c, n in cells.items() if letter in c[0]) - removed,
                    sum(n for c, n in cells.items() if c[0] == {letter}), sum(n for c, n in gone.items() if c[1]), sum(n for c, n in gone.items() if c[2]),
                ])
        out += [(*f, shares[f[1][f[2] - 1]]) for f in found]
    return sorted(out, key=repr)


def test_audit_query(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    want = plain_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
    assert listed(QUERIES["op13_filter_audit"](spark, small)) == want


def test_audit_edges(spark, edges, nothing):
    labels = spark.createDataFrame(
        [(1, 1, 0, "x"), (2, 0, 1, "x"), (2, 1, 0, "x"), (8, None, None, "x"), (None, 1, 1, "x"), (99, 1, 1, "x")], "doc_id long, quality int, toxic int, part string")
    extra = spark.createDataFrame(
        [(i, t, p, "clash", 1) for i, t, p in ((20, "AB # " * 200, ""), (21, "AB # " * 200, None), (20, "AB # " * 200, "en"), (None, "AB # " * 200, "en"), (22, None, ""), (2, "", None))],
        "doc_id long, text string, lang string, mask string, rows int")
    docs = edges.select("doc_id", "text", "lang").unionByName(extra, allowMissingColumns=True).fillna("clash", ["mask"])
    known = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    want = plain_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], known)
    assert listed(filter_audit.audit_filters(docs, labels)) == want
    assert filter_audit.audit_filters(nothing, labels).count() == 0
    bare = plain_audit([tuple(r) for r in docs.select("doc_id", "text", "lang").collect()], [])
    assert listed(filter_audit.audit_filters(docs, labels.where("false"))) == bare
