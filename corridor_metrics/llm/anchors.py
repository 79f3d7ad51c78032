"""Window anchors: content-defined places by which equal byte windows of a corpus meet.

Every window of ``width`` bytes owns one anchor, the leftmost k-gram of least hash inside
it. Equal windows own equal anchors at equal distance, wherever they stand, so windows
only need comparing with windows of the same anchor hash. Neighbouring windows share their
anchor, which makes about one *run* of windows for each ``(width - k) / 2`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

K = 24
BLOCK = 1 << 19  # window starts hashed at a time
_INDEX_BITS = 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)

_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * _MIX
    x = x ^ (x >> np.uint64(29))
    return x * _MIX


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b)])) for b in (_BASE, inverse)]
    return _powers[0], _powers[1]


def runs_of_block(data: np.ndarray, ends: np.ndarray, width: int, k: int = K) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor in texts laid end to end.

    ``ends`` are the ends of the texts. Returns arrays (lo, hi, anchor hash, run hash);
    the run hash stands for the run's bytes and the anchor's place in them.
    """
    n = len(data)
    none = (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),) * 2
    if n < width:
        return none
    up, down = _tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    grams = mix((total[k:] - total[:-k]) * down[: n - k + 1])
    low = np.uint64((1 << _INDEX_BITS) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span, want = 1, width - k + 1
    while span * 2 <= want:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < want:
        least = np.minimum(least[: len(least) - (want - span)], least[want - span :])
    anchor = (least & low).astype(np.int64)
    limit = np.repeat(ends, np.diff(ends, prepend=0))[: len(anchor)]
    valid = np.arange(len(anchor)) + width <= limit
    starts = valid.copy()
    starts[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    lo = np.flatnonzero(starts)
    stops = valid.copy()
    stops[:-1] &= starts[1:] | ~valid[1:]
    hi = np.flatnonzero(stops)
    at = anchor[lo]
    content = (total[hi + width] - total[lo]) * down[lo]
    shape = ((hi - lo) * 1024 + (at - lo)).astype(np.uint64)
    return lo, hi, grams[at], mix(content + mix(shape + np.uint64(1)))


def runs(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of runs as (index of the text, lo, hi, anchor hash, run hash); offsets are within the text.

    Small texts share a block; a long text is cut into overlapping blocks, so that memory
    does not depend on its length. A run may then be cut in two, which changes no window.
    Blocks do not follow the order of the texts: small texts may wait while a long one passes.
    """
    pending: list[int] = []
    size = 0

    def flush() -> tuple[np.ndarray, ...]:
        lengths = np.array([len(texts[i]) for i in pending], np.int64)
        ends = np.cumsum(lengths)
        lo, hi, key, run = runs_of_block(np.frombuffer(b"".join(texts[i] for i in pending), np.uint8), ends, width)
        which = np.searchsorted(ends, lo, side="right")
        base = (ends - lengths)[which]
        return np.array(pending, np.int64)[which], lo - base, hi - base, key, run

    for i, text in enumerate(texts):
        if len(text) < width:
            continue
        if len(text) > BLOCK:
            view = np.frombuffer(text, np.uint8)
            for at in range(0, len(text) - width + 1, BLOCK):
                piece = view[at : at + BLOCK + width - 1]
                lo, hi, key, run = runs_of_block(piece, np.array([len(piece)]), width)
                yield np.full(len(lo), i, np.int64), lo + at, hi + at, key, run
            continue
        if size + len(text) > BLOCK:
            yield flush()
            pending, size = [], 0
        pending.append(i)
        size += len(text)
    if pending:
        yield flush()
