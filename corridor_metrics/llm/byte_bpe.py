"""Byte-level BPE as a transducer over bytes, and streaming decoding.

A BPE result is the one split into tokens in which every token encodes to itself and every
two neighbours encode to themselves side by side. So each prefix of a text has one result,
and its last token is the only token that ends there and fits behind the result before it.

The transducer reads bytes. Its state holds, for every place where a token may still be
open, the open token's node in the vocabulary trie and the ids decided on the way to that
place but not yet emitted. Ids that all open places share are emitted, so the delay is
bounded by the longest token. States are determinised when they are first reached, and stored
with their transitions up to a number of bytes. A match that leaves the stored states while the
table is full goes on by the same transitions, worked out as it is read and not stored; after
many of these the table starts again, so that it follows the text. Every match that is no token
itself, short or long, is read this way.

Texts are split by the pattern of the vocabulary; results of words that recur are remembered.

Defined results: NULL counts as empty and gives no ids; invalid UTF-8 is read with
replacement characters; repeated rows give equal rows; order of rows is not kept.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.llm.common import gathered, payload

STATE_BYTES = 96 << 20  # of stored transducer states, as estimated when they are added
MEMO_BYTES = 192 << 20  # of remembered words and their ids, in the same way
WORD = 64  # longer words are not remembered
PAIRS = 600_000  # pairs of tokens remembered
CHUNK_BYTES = 2 << 20

ENCODED = "doc_id long, n_tokens long, ids binary"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


class BpeTransducer:
    """Emits token ids for a byte string; one instance per worker."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.edges: dict[int, int] = {}  # node * 256 + byte: the trie's next node
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                key = node << 8 | byte
                node = self.edges.get(key, 0)
                if not node:
                    node = self.edges[key] = len(self.token_at)
                    self.token_at.append(-1)
            self.token_at[node] = rank
        self.inner = bytearray(len(self.token_at))  # nodes with edges
        for key in self.edges:
            self.inner[key >> 8] = 1
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.span = 1 + max(ranks.values(), default=0)
        self.fits: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, ...] | None] = {}
        self._reset()

    def _reset(self) -> None:
        start = self._pack([(0, (), -1)])
        self.ids = {start: 0}
        self.packed = [start]  # states
        self.following: dict[int, int] = {}  # state * 256 + byte: the next state, as ~state where ids are emitted
        self.emitted: dict[int, bytes] = {}  # by the same key: these ids
        self.size = self.unstored = 0

    @property
    def states(self) -> list[list[tuple[int, tuple[int, ...], int]]]:
        """The open places of every stored state, to look at."""
        return [self._places(state) for state in range(len(self.packed))]

    @property
    def moves(self) -> dict[int, tuple[int, tuple[int, ...]]]:
        """The stored transitions, to look at: by state * 256 + byte the next state and the emitted ids."""
        return {key: (max(to, ~to), tuple(array("I", self.emitted.get(key, b"")))) for key, to in self.following.items()}

    @staticmethod
    def _pack(places) -> bytes:
        """A state as 32-bit integers: node, last id, undelivered ids and their number for each place."""
        return array("i", [x for node, waiting, last in places for x in (node, last, *waiting, len(waiting))]).tobytes()

    def _places(self, state: int) -> list[tuple[int, tuple[int, ...], int]]:
        values, places = array("i", self.packed[state]), []
        end = len(values)
        while end:
            start = end - 3 - values[end - 1]
            places.append((values[start], tuple(values[start + 2 : end - 1]), values[start + 1]))
            end = start
        return places[::-1]

    def _undelivered(self, state: int) -> array:
        """Ids that are left when a match ends in this state."""
        values = array("i", self.packed[state])
        return values[len(values) - 1 - values[-1] : -1]

    def _stands(self, token: int) -> bool:
        """Whether a token encodes to itself; remembers the two parts of its last merge."""
        known = self.halves.get(token)
        if known is None:
            whole = self.bytes_of[token]
            parts = [whole[i : i + 1] for i in range(len(whole))]
            while len(parts) > 2:
                pairs = [(self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, i = min(pairs)
                if rank == 1 << 60:
                    break
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            known = self.halves[token] = () if len(parts) == 1 else tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return known is not None

    def _follows(self, before: int, token: int) -> bool:
        """Whether ``token`` encodes to itself and can stand behind ``before`` (-1: at the start).

        Merges next to the boundary are undone, the latest first. The pair fails if, at any
        point, the pieces that touch would have merged before the merge undone last; equal
        ranks merge from the left.
        """
        if len(self.fits) > PAIRS:
            self.fits.clear()
        known = self._stands(token)
        if known and before >= 0:
            left, right, bound = before, token, 1 << 60
            while True:
                joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
                if joined is not None and joined < bound:
                    known = False
                    break
                of_left = self.halves[left] if self._stands(left) else ()
                of_right = self.halves[right] if self._stands(right) else ()
                if of_left and (left > right or not of_right):
                    bound, left = left, of_left[1]
                elif of_right:
                    bound, right = right + 1, of_right[0]
                else:
                    break
        self.fits[before * self.span + token] = known
        return known

    def _advance(self, places, byte: int):
        """Open places after one more byte, as (trie node, undelivered ids, last id), and the emitted ids.

        The last place is the one behind the token that ends here; the first is the oldest, and
        nothing is shared if it waits for nothing.
        """
        edges, token_at, inner, fits, span = self.edges, self.token_at, self.inner, self.fits, self.span
        live, ended = [], None
        for node, waiting, last in places:
            nxt = edges.get(node << 8 | byte)
            if nxt is None:
                continue
            if ended is None:
                token = token_at[nxt]
                if token >= 0:
                    known = fits.get(last * span + token)
                    if known is None:
                        known = self._follows(last, token)
                    if known:
                        ended = (0, (*waiting, token), token)
            if inner[nxt]:
                live.append((nxt, waiting, last))
        live.append(ended)
        out = live[0][1]
        if not out:
            return live, out
        shared, shortest = 0, min(len(w) for _, w, _ in live)
        while shared < shortest and all(w[shared] == out[shared] for _, w, _ in live):
            shared += 1
        if not shared:
            return live, ()
        return [(node, w[shared:], last) for node, w, last in live], out[:shared]

    def _store(self, state: int, byte: int) -> int:
        """Determinises one transition, and gives it as it is stored."""
        live, out = self._advance(self._places(state), byte)
        packed = self._pack(live)
        found = self.ids.setdefault(packed, len(self.packed))
        if found == len(self.packed):
            self.packed.append(packed)
            self.size += 140 + len(packed)
        key = state << 8 | byte
        self.size += 100
        if out:
            found = ~found
            self.emitted[key] = array("I", out).tobytes()
            self.size += 130 + 4 * len(out)
        self.following[key] = found
        return found

    def __call__(self, piece: bytes) -> list[int]:
        """Ids of one pattern match."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, result, moves, places = 0, array("I"), self.following, None
        emitted = self.emitted
        for at, byte in enumerate(piece):
            move = moves.get(state << 8 | byte)
            if move is None:
                if self.size > STATE_BYTES:
                    places = self._places(state)
                    break
                move = self._store(state, byte)
            if move < 0:
                result.frombytes(emitted[state << 8 | byte])
                state = ~move
            else:
                state = move
        if places is None:
            result.extend(array("I", self._undelivered(state)))
            return result.tolist()
        for byte in piece[at:]:  # the table is full
            places, out = self._advance(places, byte)
            result.extend(out)
        result.extend(places[-1][1])
        self.unstored += len(piece) - at
        if self.unstored > 16 * len(self.following):
            self._reset()
        return result.tolist()


class TextEncoder:
    """Ids of whole texts as little-endian 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.piece = BpeTransducer(load_ranks(path))
        self.find = regex.compile(pattern).findall
        self.doubled = regex.compile(r"\s\s|^\s|\s$").search
        self.memo: dict[str, bytes] = {}
        self.size = 0

    def _ids(self, words: list[str]) -> bytes:
        memo = self.memo
        known = [memo.get(w) for w in words]
        if None in known:
            if self.size > MEMO_BYTES:
                memo.clear()
                self.size = 0
            for i, value in enumerate(known):
                if value is None:
                    word = words[i]
                    value = memo.get(word)
                    if value is None:
                        ids = [x for p in self.find(word) for x in self.piece(p.encode())]
                        value = array("I", ids).tobytes()
                        if len(word) <= WORD:
                            memo[word] = value
                            self.size += 180 + 4 * len(word) + len(value)
                    known[i] = value
        return b"".join(known)

    def __call__(self, text: str) -> bytes:
        """A match never crosses a single space that stands before a word, so such words are looked up whole."""
        if self.doubled(text):
            return self._ids(self.find(text))
        words = text.split(" ")
        return self._ids(words[:1] + [" " + w for w in words[1:]]) if text else b""


class StreamingDecoder:
    """Text from ids that arrive in any portions; bytes of an unfinished character wait.

    The machine counts the continuation bytes that the last lead byte still asks for.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.rest = b""

    @staticmethod
    def unfinished(data: bytes) -> int:
        """How many bytes at the end are the start of a longer character."""
        for back in range(1, min(4, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < need else 0
        return 0

    def feed(self, ids) -> str:
        data = self.rest + b"".join(map(self.bytes_of.__getitem__, ids))
        cut = len(data) - self.unfinished(data)
        self.rest = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        data, self.rest = self.rest, b""
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    """One encoder for all tasks of a worker, so that its tables stay warm."""
    return TextEncoder(path, pattern)


def _encode(path: str, pattern: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        for batch in gathered(batches, "text", CHUNK_BYTES):
            ids = [encoder(t.decode("utf-8", "replace")) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc").combine_chunks(), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    return encode


def bpe_encode(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit) for each row."""
    docs = df.select(F.col(id_col).cast("long").alias("doc"), payload(text_col).alias("text"))
    return docs.mapInArrow(_encode(ranks_path, pattern), ENCODED)


def _decode(path: str, portion: int):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = {rank: token for token, rank in load_ranks(path).items()}
        for batch in gathered(batches, "ids", 4 * CHUNK_BYTES):
            texts = []
            for ids in batch.column("ids").to_pylist():
                decoder = StreamingDecoder(bytes_of)
                values = np.frombuffer(ids, "<u4").tolist()
                parts = [decoder.feed(values[at : at + portion]) for at in range(0, len(values), portion)]
                texts.append("".join([*parts, decoder.finish()]))
            table = batch.append_column("decoded", pa.array(texts, pa.string()))
            yield from table.to_batches()

    return decode


def bpe_decode(encoded: DataFrame, ranks_path: str, portion: int = 4096) -> DataFrame:
    """``encoded`` with a column ``decoded``; ids are fed to the decoder a portion at a time."""
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(_decode(ranks_path, portion), ENCODED + ", decoded string")


def _round_trip(path: str, pattern: str, portion: int):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path, pattern)
        bytes_of = encoder.piece.bytes_of
        for batch in gathered(batches, "text", CHUNK_BYTES):
            counts, first, second = [], [], []
            for text in batch.column("text").to_pylist():
                ids = encoder(text.decode("utf-8", "replace"))
                decoder, digest = StreamingDecoder(bytes_of), hashlib.sha256()
                values = np.frombuffer(ids, "<u4").tolist()
                for at in range(0, len(values), portion):
                    digest.update(decoder.feed(values[at : at + portion]).encode())
                digest.update(decoder.finish().encode())
                counts.append(len(values))
                first.append(hashlib.sha256(ids).hexdigest())
                second.append(digest.hexdigest())
            yield pa.record_batch(
                [batch.column("doc").combine_chunks(), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digests


def bpe_round_trip(
    df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", portion: int = 65536
) -> DataFrame:
    """Encode and decode each text in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = df.select(F.col(id_col).cast("long").alias("doc"), payload(text_col).alias("text"))
    return docs.mapInArrow(_round_trip(ranks_path, pattern, portion), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
