"""Text quality from a byte-level convolutional network in numpy.

Bytes are embedded, overlapping chunks cover the whole text, learned filters slide over
each chunk, and a chunk keeps every filter's greatest response. The mean and the greatest of
these over all chunks are combined into one probability. Max-pooling also makes training
cheap: a filter's gradient flows to one window per chunk.

The network is fitted on the driver to a sample of labelled rows, bounded by ``Settings.sample``
rows of at most ``Settings.sample_bytes`` bytes each. Scoring reads every text whole.

Defined results: NULL and empty texts are one chunk of padding and get a score like any
other; rows that repeat get equal scores; labels, ids and other columns are no input. Without labelled
rows of both kinds the untrained prior (0.5 or the share of label 1) is returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor_metrics.llm.common import payload

PAD = 256
THRESHOLD = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Settings:
    """Shape of the network, and bounds of the sample it is fitted to."""

    embedding: int = 6
    width: int = 8
    stride: int = 2
    filters: int = 24
    chunk: int = 1024
    step: int = 960
    sample: int = 3000
    sample_bytes: int = 1 << 16
    epochs: int = 12  # or more, until `turns` batches are seen
    turns: int = 800
    batch: int = 16
    rate: float = 0.004
    seed: int = 7


class ByteCNN:
    """The network; ``bytes_in`` of one text at a time, any length."""

    def __init__(self, settings: Settings = Settings()):
        s = self.settings = settings
        rng = np.random.default_rng(s.seed)
        self.embed = rng.normal(0, 0.5, (PAD + 1, s.embedding)).astype(np.float32)
        self.embed[PAD] = 0
        self.weight = rng.normal(0, (2 / (s.width * s.embedding)) ** 0.5, (s.width * s.embedding, s.filters)).astype(np.float32)
        self.bias = np.zeros(s.filters, np.float32)
        self.out = rng.normal(0, 0.1, 2 * s.filters).astype(np.float32)
        self.prior = np.zeros(1, np.float32)

    def chunks(self, text: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
        """Overlapping chunks of a text as rows, padded; some of them if asked."""
        s = self.settings
        total = self.count(len(text))
        last = total if count is None else min(total, first + count)
        rows = np.full((last - first, s.chunk), PAD, np.int16)
        for i in range(first, last):
            piece = np.frombuffer(text[i * s.step : i * s.step + s.chunk], np.uint8)
            rows[i - first, : len(piece)] = piece
        return rows

    def count(self, size: int) -> int:
        s = self.settings
        return 1 + max(0, -(-(size - s.chunk) // s.step))

    def _windows(self, rows: np.ndarray) -> np.ndarray:
        s = self.settings
        return np.lib.stride_tricks.sliding_window_view(rows, s.width, axis=1)[:, :: s.stride]

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """Filter responses (chunk, place, filter)."""
        s = self.settings
        places = (s.chunk - s.width) // s.stride + 1
        wide = self.embed[rows]
        view = np.lib.stride_tricks.as_strided(
            wide, (len(rows), places, s.width * s.embedding),
            (wide.strides[0], s.stride * wide.strides[1], wide.itemsize), writeable=False,
        )
        flat = np.ascontiguousarray(view).reshape(-1, s.width * s.embedding)
        return (flat @ self.weight).reshape(len(rows), places, s.filters)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Greatest response of each filter in each chunk, cut at zero."""
        parts = [self.responses(rows[at : at + 16]).max(axis=1) for at in range(0, len(rows), 16)]
        return np.maximum(np.concatenate(parts) + self.bias, 0)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each text."""
        s = self.settings
        result = np.empty(len(texts))
        group, owners = [], []

        def flush() -> None:
            if group:
                pooled = self.pooled(np.concatenate(group))
                heads = np.cumsum([0, *(len(g) for g in group[:-1])])
                sums, most = np.add.reduceat(pooled, heads), np.maximum.reduceat(pooled, heads)
                sizes = np.array([len(g) for g in group])[:, None]
                result[owners] = self._probability(np.concatenate([sums / sizes, most], axis=1))
                group.clear()
                owners.clear()

        held = 0
        for i, text in enumerate(texts):
            n = self.count(len(text))
            if n > 512:  # a long text: its chunks are pooled in portions
                total, most = np.zeros(s.filters), np.zeros(s.filters)
                for at in range(0, n, 256):
                    pooled = self.pooled(self.chunks(text, at, 256))
                    total, most = total + pooled.sum(axis=0), np.maximum(most, pooled.max(axis=0))
                result[i] = self._probability(np.concatenate([total / n, most])[None])[0]
                continue
            group.append(self.chunks(text))
            owners.append(i)
            held += n
            if held >= 256:
                flush()
                held = 0
        flush()
        return result

    def _probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.out + self.prior[0], -30, 30)))

    def fit(self, texts: list[bytes], labels: np.ndarray) -> ByteCNN:
        """Adam on the mean log loss."""
        s = self.settings
        share = float(np.mean(labels)) if len(labels) else 0.5
        if len(labels) == 0 or share in (0.0, 1.0):
            self.out[:] = 0
            self.prior[0] = np.log((share * 0.98 + 0.01) / (1 - share * 0.98 - 0.01))
            return self
        rows = [self.chunks(t) for t in texts]
        parameters = [self.embed, self.weight, self.bias, self.out, self.prior]
        first, second = ([np.zeros_like(p) for p in parameters] for _ in range(2))
        rng = np.random.default_rng(s.seed + 1)
        turn = 0
        epochs = max(s.epochs, -(-s.turns * s.batch // len(rows)))
        for epoch in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), s.batch):
                chosen = order[at : at + s.batch]
                turn += 1
                rate = s.rate * (0.5 if epoch >= epochs * 2 // 3 else 1.0)
                for p, g, m, v in zip(parameters, self._gradients([rows[i] for i in chosen], labels[chosen]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
                self.embed[PAD] = 0
        return self

    def _gradients(self, texts: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
        s = self.settings
        rows = np.concatenate(texts)
        sizes = np.array([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), sizes)
        heads = np.cumsum(sizes) - sizes
        best, place = [], []
        for at in range(0, len(rows), 16):
            found = self.responses(rows[at : at + 16])
            spot = found.argmax(axis=1)
            place.append(spot)
            best.append(np.take_along_axis(found, spot[:, None], axis=1)[:, 0])
        pooled, place = np.maximum(np.concatenate(best) + self.bias, 0), np.concatenate(place)
        most = np.maximum.reduceat(pooled, heads)
        features = np.concatenate([np.add.reduceat(pooled, heads) / sizes[:, None], most], axis=1)
        error = ((self._probability(features) - labels) / len(labels)).astype(np.float32)
        g_out = features.T @ error + 1e-4 * self.out
        back = error[:, None] * self.out[None]
        top = pooled == most[owner]
        flow = back[owner, : s.filters] / sizes[owner, None] + back[owner, s.filters :] * top / np.maximum(np.add.reduceat(top, heads)[owner], 1)
        flow = flow * (pooled > 0)
        taken = self._windows(rows)[np.arange(len(rows))[:, None], place]  # (chunk, filter, width)
        seen = self.embed[taken].reshape(len(rows), s.filters, -1)
        g_weight = np.einsum("cf,cfk->kf", flow, seen)
        push = (flow[:, :, None] * self.weight.T[None]).reshape(-1, s.embedding)
        flat = taken.reshape(-1)
        g_embed = np.stack([np.bincount(flat, push[:, e], PAD + 1) for e in range(s.embedding)], axis=1)
        return [g_embed.astype(np.float32), g_weight.astype(np.float32), flow.sum(axis=0).astype(np.float32), g_out.astype(np.float32), np.array([error.sum()], np.float32)]


def held_out(doc_id: Column) -> Column:
    """The fold of an id that is never trained on."""
    return F.pmod(F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0).cast("long")), F.lit(FOLDS)) == 0


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> ByteCNN:
    """Fit to a bounded sample of labelled rows outside the held-out fold, chosen by the hash of their id."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"))
    )
    picked = known.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(settings.sample)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), payload(text_col).alias("text")).where(
        F.octet_length("text") <= settings.sample_bytes
    )
    rows = texts.join(F.broadcast(picked), "id").select("id", "text", "label").orderBy("id", F.sha1("text")).limit(2 * settings.sample).collect()
    return ByteCNN(settings).fit([bytes(r.text) for r in rows], np.array([r.label for r in rows]))


def score(model: ByteCNN, text: Column) -> Column:
    """Score of a text column."""

    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        parts = [model.scores(texts[at : at + 256].to_pylist()) for at in range(0, len(texts), 256)]
        return pa.array(np.concatenate(parts or [np.zeros(0)]))

    return score_of(payload(text))


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, settings, id_col, text_col, label_col)
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), score(model, F.col(text_col)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
