"""Periodic runs of words, from a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal) that no
neighbouring word extends. It counts if it holds at least ``MIN_LENGTH`` words and ``MIN_POWER`` periods.

Words are appended one by one to a suffix automaton. Its suffix links form a tree; the strings that end at
the new word are the path from the newest state to the root. Every state is coloured with the last place
where its strings ended. A link-cut tree keeps the path of one appended word as one segment, so all states
of a segment have one colour and appending recolours the path by cutting and joining few segments. Before
a segment is recoloured, its colour ``e`` and the length ``m`` of its longest string say that the ``m``
words up to ``e`` and up to the new place ``i`` agree, and no more than these. With distance ``d = i - e``
not above ``m`` that is a square of period ``d``, which starts at ``i - d - m + 1``; the squares of one start and
distance, place after place, are one run. ``d`` is the smallest period, or the same string would
have ended later than ``e``.

Words that can be in no run are not appended: within a run of period ``q`` every word after the first
``q`` occurred at most ``q`` words before, and there are ``(MIN_POWER - 1) * q`` such words in a row. Stretches that
meet this for some power of two not below the period are searched, each on its own; a run lies in one of them as a whole.

Each text is one row in one task; nothing is shuffled. The automaton takes about 80 bytes a word, and the
appended words of a text take O(log n) steps each. Words are maximal strings without the bytes 09 to 0D and 20.

Defined results: NULL and empty texts have no words and no runs; rows that repeat are reported each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor_metrics.llm.common import gathered, payload

MIN_LENGTH = 6
MIN_POWER = 4

Run = tuple[int, int, int]  # start, length, period


class SquareFinder:
    """Suffix automaton over word numbers whose link tree is a link-cut tree.

    States are numbered from 1, the root; 0 is none. ``left`` holds shallower and ``right`` deeper states of
    a segment; ``up`` is the parent in the segment's tree or, at its top, the state above the segment.
    ``last``, the colour, is kept at the top of each segment's tree only.
    """

    def __init__(self, size: int):
        room = 2 * size + 2
        self.length, self.link, self.left, self.right, self.up, self.to = (array("i", bytes(4 * room)) for _ in range(6))
        self.word, self.last = (array("i", b"\xff" * (4 * room)) for _ in range(2))  # -1: none, nowhere yet
        self.more: dict[int, dict[int, int]] = {}  # transitions beside the first one of a state
        self.states = self.newest = 1
        self.place = -1

    def _splay(self, x: int) -> None:
        """Make ``x`` the top of its segment's tree; the colour moves along."""
        left, right, up = self.left, self.right, self.up
        p = up[x]
        while left[p] == x or right[p] == x:
            g = up[p]
            inner = p == left[g] or p == right[g]
            if inner:
                above = up[g]
                if left[g] == p:
                    if left[p] == x:
                        b = left[g] = right[p]
                        up[b] = g
                        right[p], up[g] = g, p
                        b = left[p] = right[x]
                        up[b] = p
                        right[x], up[p] = p, x
                    else:
                        b = right[p] = left[x]
                        up[b] = p
                        b = left[g] = right[x]
                        up[b] = g
                        left[x], up[p] = p, x
                        right[x], up[g] = g, x
                elif right[p] == x:
                    b = right[g] = left[p]
                    up[b] = g
                    left[p], up[g] = g, p
                    b = right[p] = left[x]
                    up[b] = p
                    left[x], up[p] = p, x
                else:
                    b = left[p] = right[x]
                    up[b] = p
                    b = right[g] = left[x]
                    up[b] = g
                    right[x], up[p] = p, x
                    left[x], up[g] = g, x
                old = g
            else:
                above = g
                if left[p] == x:
                    b = left[p] = right[x]
                    up[b] = p
                    right[x], up[p] = p, x
                else:
                    b = right[p] = left[x]
                    up[b] = p
                    left[x], up[p] = p, x
                old = p
            up[x] = p = above
            if left[p] == old:
                left[p] = x
            elif right[p] == old:
                right[p] = x
            else:
                self.last[x] = self.last[old]
                return

    def _target(self, state: int, word: int) -> int:
        if self.word[state] == word:
            return self.to[state]
        others = self.more.get(state)
        return others.get(word, 0) if others else 0

    def _aim(self, state: int, word: int, target: int) -> None:
        if self.word[state] < 0 or self.word[state] == word:
            self.word[state], self.to[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def _extend(self, word: int) -> int:
        """Add the state of all words so far, below its suffix link; its segment is itself alone."""
        length, link, up = self.length, self.link, self.up
        new = self.states = self.states + 1
        self.place += 1
        length[new] = self.place + 1
        p, q = self.newest, 0
        self.newest = new
        while p and not (q := self._target(p, word)):
            self._aim(p, word, new)
            p = link[p]
        if not p:
            q = 1
        elif length[p] + 1 != length[q]:
            copy = self.states = self.states + 1
            length[copy], link[copy] = length[p] + 1, link[q]
            self.word[copy], self.to[copy] = self.word[q], self.to[q]
            if q in self.more:
                self.more[copy] = dict(self.more[q])
            # its strings ended last where those of q did: it comes right above q in the same segment
            self._splay(q)
            b = self.left[copy] = self.left[q]
            up[b] = copy
            self.left[q], up[copy] = copy, q
            link[q] = copy
            while p and self._target(p, word) == q:
                self._aim(p, word, copy)
                p = link[p]
            q = copy
        link[new] = up[new] = q
        return new

    def append(self, word: int) -> list[tuple[int, int]]:
        """Add a word, recolour its path, and return (distance, common words) of the squares that end here."""
        below = self._extend(word)
        right, up, last, place = self.right, self.up, self.last, self.place
        squares = []
        x = up[below]
        while x:
            self._splay(x)
            colour, common = last[x], self.length[x]
            if 0 <= place - common <= colour:
                squares.append((place - colour, common))
            cut = right[x]
            if cut:
                last[cut] = colour
            right[x] = below
            below = x
            x = up[x]
        last[below] = place
        return squares


def runs_of(words: list[int], min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> list[Run]:
    """All runs of a sequence of small numbers, by start and period."""
    finder = SquareFinder(len(words))
    ends: dict[tuple[int, int], int] = {}
    for place, word in enumerate(words):
        for distance, common in finder.append(word):
            if distance + common >= max(min_length, min_power * distance):
                ends[place - distance - common + 1, distance] = place
    return [(start, end - start + 1, period) for (start, period), end in sorted(ends.items())]


def candidate_stretches(words: np.ndarray, texts: np.ndarray, min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> list[tuple[int, int]]:
    """Disjoint [first, end) of word places that hold every run as a whole; ``texts`` numbers the text of each word."""
    n = len(words)
    if n == 0:
        return []
    key = texts * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    back = np.full(n, np.iinfo(np.int64).max)  # words back to the last equal one of the text
    again = np.flatnonzero(key[order[1:]] == key[order[:-1]]) + 1
    back[order[again]] = order[again] - order[again - 1]
    opening = np.searchsorted(texts, texts, "left") if len(again) else texts
    firsts, ends = [], []
    most = int(np.bincount(texts).max())
    reach = 1
    while (least := max(1, min_length - reach, (min_power - 1) * (reach // 2 + 1))) <= most:
        near = np.concatenate([[False], back <= reach, [False]])
        edges = np.flatnonzero(near[1:] != near[:-1])
        lo, hi = edges[::2], edges[1::2]
        lo, hi = lo[hi - lo >= least], hi[hi - lo >= least]
        firsts.append(np.maximum(lo - reach, opening[lo]))
        ends.append(hi)
        reach *= 2
    if not firsts:
        return []
    lo, hi = np.concatenate(firsts), np.concatenate(ends)
    merged: list[tuple[int, int]] = []
    for first, end in sorted(zip(lo.tolist(), hi.tolist())):
        if merged and first < merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((first, end))
    return merged


def runs_of_texts(texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> list[list[Run]]:
    """Runs of each of some texts, given as words."""
    numbers: dict[bytes, int] = {}
    words = np.array([numbers.setdefault(w, len(numbers)) for text in texts for w in text], np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    opening = np.cumsum(sizes) - sizes
    found: list[list[Run]] = [[] for _ in texts]
    for first, end in candidate_stretches(words, owner, min_length, min_power):
        _, small = np.unique(words[first:end], return_inverse=True)
        at = int(owner[first])
        shift = first - int(opening[at])
        found[at] += [(start + shift, length, period) for start, length, period in runs_of(small.tolist(), min_length, min_power)]
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats, joined by blanks: of each run its first period stays, unless another run drops it."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(kept)])


SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
PORTION = 4 << 20


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", min_length: int = MIN_LENGTH, min_power: int = MIN_POWER) -> DataFrame:
    """One row per document: doc_id, n_words, runs by start and period, and the text without repeated periods.

    ``min_power``, the least number of periods, is at least 2.
    """
    if min_power < 2:
        raise ValueError("min_power must be at least 2")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, "text", PORTION):
            texts = [t.split() for t in rows.column("text").to_pylist()]  # bytes split at 09-0D and 20
            runs = runs_of_texts(texts, min_length, min_power)
            columns = [
                rows.column("doc_id").combine_chunks(),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], pa.list_(run)),
                pa.array([collapsed(t, found) for t, found in zip(texts, runs)], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), payload(text_col).alias("text"))
    return rows.mapInArrow(search, SCHEMA)
