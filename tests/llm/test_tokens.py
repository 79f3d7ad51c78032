import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from pyarrow import fs
from tokenizers import Tokenizer

from corridor_metrics.llm import byte_bpe, token_files
from corridor_metrics.llm.queries import QUERIES, fresh_folder
from edge_cases import edges, nothing, shipped  # noqa: F401

WORDS, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_multi_50k.tiktoken")
POOL = [" ", "  ", "\n", "\t", " ", "　", "'s", "n't", "abc", "The", "123", "１", "é", "中文", "\U0001f642", "###", "...", "\x1c", "\x85", "Σ", "ΑΣ", "İ", "<|endoftext|>", "ﬁ"]


def samples(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(POOL) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_words_give_the_ids_of_whole_texts():
    texts = samples(3000)
    want = [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    got = token_files.WordEncoder(WORDS)(pa.array([t.encode() for t in texts]))
    assert [g.tolist() for g in got] == want


def expected_files(rows):
    tokenizer, out, start = Tokenizer.from_file(WORDS), [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def written(spark, df, **sizes):
    folder = fresh_folder(spark, "tokens")
    manifest = token_files.write_token_files(df, WORDS, folder, 1, **sizes)
    found = token_files.read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
    return folder, manifest, sorted((tuple(r) for r in found.collect()), key=repr)


def test_files_hold_all_texts(spark, edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    folder, manifest, got = written(spark, edges, length=8, rows=4)
    assert got == expected_files(rows)
    assert written(spark, nothing)[2] == []
    filesystem, _ = fs.FileSystem.from_uri(folder)
    for row in manifest.where("n_tokens > 0").collect():
        file = token_files.SequenceFile(filesystem, f"{row.path}.arrow")
        n = -(-row.n_tokens // 8)
        before = pa.total_allocated_bytes()
        ids, mask = file.sequence(n - 1)
        assert not ids.flags.owndata and pa.total_allocated_bytes() - before < 1 << 12
        left = row.n_tokens - 8 * (n - 1)
        assert mask.to_pylist() == [True] * left + [False] * (8 - left)
        assert all(file.file.get_batch(k).num_rows == 4 for k in range(file.file.num_record_batches - 1))


def test_token_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    got = sorted((tuple(r) for r in QUERIES["op1_token_files"](spark, small).collect()), key=repr)
    assert got == expected_files([(r.doc_id, r.text) for r in docs])


def tiktoken_ids(texts):
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(RANKS), special_tokens={})
    return [coder.encode_ordinary(t) for t in texts]


def test_transducer_against_tiktoken():
    coder = byte_bpe.TextEncoder(RANKS, P.PATTERN)
    texts = samples(3000, 4)
    for text, want in zip(texts, tiktoken_ids(texts)):
        assert np.frombuffer(coder(text), "<u4").tolist() == want


def test_matches_of_every_length():
    """Matches of 3 to 200 bytes, from letters of few and of many tokens."""
    rng = random.Random(8)
    letters = ["ab", "aeiounthsrl", "abcdefghijklmnopqrstuvwxyz", "éüßñ", "中文字"]
    texts = ["".join(rng.choice(alphabet) for _ in range(n)) for n in range(1, 201) for alphabet in letters]
    texts += ["a" * n for n in (31, 64, 65, 199)] + ["=" * n for n in range(3, 201, 7)]
    coder = byte_bpe.BpeTransducer(byte_bpe.load_ranks(RANKS))
    for text, want in zip(texts, tiktoken_ids(texts)):
        assert coder(text.encode()) == want


def test_every_match_goes_through_the_transducer(monkeypatch):
    """Each byte of a match that is no token is a stored transition or one worked out by ``_advance``."""
    coder = byte_bpe.BpeTransducer(byte_bpe.load_ranks(RANKS))
    calls = []
    advance = byte_bpe.BpeTransducer._advance
    monkeypatch.setattr(byte_bpe.BpeTransducer, "_advance", lambda self, places, byte: calls.append(byte) or advance(self, places, byte))
    pieces = [w.encode() for w in ("thountea", "therlyly", "thountea", "x" * 70 + "yz", "unbelievablyinterconnectednesses")]
    for piece in pieces:
        assert piece not in coder.ranks
        ids, state, walked = coder(piece), 0, []
        for byte in piece:
            state, out = coder.moves[state << 8 | byte]
            walked.extend(out)
        assert ids == [*walked, *coder.states[state][-1][1]]
    assert len(calls) == len(coder.moves) < sum(map(len, pieces))  # each transition is worked out once
    monkeypatch.setattr(byte_bpe, "STATE_BYTES", -1)
    coder._reset()
    for piece in pieces:  # nothing is stored where there is no room
        calls.clear()
        coder(piece)
        assert bytes(calls) == piece and not coder.moves


def test_ids_are_emitted_after_bounded_lookahead():
    coder = byte_bpe.BpeTransducer(byte_bpe.load_ranks(RANKS))
    places, waits, emitted = coder.states[0], [], 0
    for byte in b"thountea" * 40:
        places, out = coder._advance(places, byte)
        emitted += len(out)
        waits.append(max(len(w) for _, w, _ in places))
    assert emitted > 50 and max(waits) <= max(map(len, coder.ranks))


def test_transducer_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(byte_bpe, "STATE_BYTES", 20_000)
    monkeypatch.setattr(byte_bpe, "MEMO_BYTES", 2_000)
    monkeypatch.setattr(byte_bpe, "PAIRS", 50)
    coder = byte_bpe.TextEncoder(RANKS, P.PATTERN)
    resets = []
    reset = coder.piece._reset
    monkeypatch.setattr(coder.piece, "_reset", lambda: resets.append(reset()))
    texts = samples(400, 5) + ["unbelievablyinterconnectedness " * 3, "".join(random.Random(1).choices("aeinst ", k=30_000))]
    for text, want in zip(texts, tiktoken_ids(texts)):
        assert np.frombuffer(coder(text), "<u4").tolist() == want
        assert coder.piece.size < 24_000
    assert resets and all(len(w) <= byte_bpe.WORD for w in coder.memo)


def test_decoder_waits_for_whole_characters():
    ranks = byte_bpe.load_ranks(RANKS)
    bytes_of = {v: k for k, v in ranks.items()}
    text = "é中\U0001f642 end"
    decoder = byte_bpe.StreamingDecoder(bytes_of)
    singles = [ranks[bytes([b])] for b in text.encode()]
    assert "".join(decoder.feed([i]) for i in singles) + decoder.finish() == text
    broken = byte_bpe.StreamingDecoder(bytes_of)
    assert broken.feed([ranks[b"a"], ranks[b"\xf0"], ranks[b"\x9f"]]) == "a"
    assert broken.finish() == "�"


def digests(rows):
    out = []
    for (doc, text), ids in zip(rows, tiktoken_ids([t or "" for _, t in rows])):
        data = np.array(ids, "<u4").tobytes()
        out.append((doc, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_round_trip_on_edges(edges, nothing):
    rows = [(r.doc_id, r.text) for r in edges.collect()]
    got = byte_bpe.bpe_round_trip(edges, RANKS, P.PATTERN, portion=3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == digests(rows)
    assert byte_bpe.bpe_round_trip(nothing, RANKS, P.PATTERN).count() == 0
    decoded = byte_bpe.bpe_decode(byte_bpe.bpe_encode(edges, RANKS, P.PATTERN), RANKS, portion=5).select("doc_id", "decoded")
    assert sorted((tuple(r) for r in decoded.collect()), key=repr) == sorted(((d, t or "") for d, t in rows), key=repr)


def test_bpe_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op5_byte_bpe"](spark, small).collect()), key=repr) == digests(rows)
