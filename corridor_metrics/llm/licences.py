"""Licences of documents: notices by TF-IDF cosine, licence files, and inheritance by folder.

Every line, sentence, paragraph, row of neighbouring legal paragraphs and the whole of a text
is compared with templates by the cosine of sparse TF-IDF vectors over the templates' terms
plus all others. Templates are one-line notices, headers and whole licence texts
(``licence_templates``). Document frequencies are counted over all documents. A part whose
known terms cannot reach the best cosine so far is not compared with each template.

A document's licence is that of its own notice; else that of the nearest licence file in its
folder or a folder above it. Folders meet licence files by joins on their paths, a row per distinct folder and
ancestor.

Defined results: NULL and empty texts and NULL paths declare nothing; a NULL path inherits nothing; ties
go to the better score, then to the template that sorts first; a file in the root folder covers
all paths; repeated rows give equal rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor_metrics.context import cut_lineage
from corridor_metrics.llm.common import gathered, payload
from corridor_metrics.llm.licence_templates import all_templates
from corridor_metrics.llm.wu_manber import words_of

# The usual one-line notices of common licences, by SPDX id.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work has been dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
FILE_NAMES = ("LICENSE", "LICENSE.txt", "LICENSE.md", "LICENCE", "COPYING", "NOTICE")
LEAST = 0.8

FOUND = "doc_id long, path string, text_crc32 long, own string, score double"


def _count(terms: frozenset[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, Counter()
        for batch in gathered(batches, "text", 4 << 20):
            for text in batch.column("text").to_pylist():
                seen.update(terms.intersection(words_of(text)))
            total += batch.num_rows
        names = sorted(seen)
        yield pa.record_batch([pa.array([b"", *names], pa.binary()), pa.array([total, *(seen[x] for x in names)], pa.int64())], names=["term", "n"])

    return count


_MARK = re.compile(rb"[ \t]*(?:#+|/{2,}|/?\*+/?|--+|;+|%+|<!--|(?:dnl|rem)\b)", re.IGNORECASE)
_SENTENCE = re.compile(rb"(?<=[.!?:;])\s+(?![a-z0-9(])")
_LEGAL = frozenset(
    b"license licence licensed licenses licences copyright copyrighted permission permissions permitted redistribution redistributions "
    b"redistribute redistributed warranty warranties liable liability".split()
)


def units(text: bytes) -> Iterator[list[bytes]]:
    """Word lists that may be a notice: lines, sentences, paragraphs, neighbouring legal paragraphs, and the whole text.

    Comment markers are left out. A paragraph ends at a line without words and where comment and other lines meet.
    """
    everything, paragraphs, fresh, before, inside = [], [], True, False, False
    for line in text.splitlines():
        mark = _MARK.match(line)
        marked = inside or mark is not None
        if (opened := line.rfind(b"/*")) >= 0 or inside:
            inside = line.find(b"*/", max(opened, 0)) < 0
        line = line[mark.end() :] if mark else line
        words = words_of(line)
        if not words:
            fresh = True
            continue
        yield words
        everything += words
        if fresh or marked != before:
            paragraphs.append((marked, [], []))
        paragraphs[-1][1].append(line)
        paragraphs[-1][2].extend(words)
        fresh, before = False, marked
    legal: list[list[bytes]] = []
    for k, (marked, lines, words) in enumerate(paragraphs):
        if len(lines) > 1 and len(paragraphs) > 1:
            yield words
        sentences = _SENTENCE.split(b" ".join(lines))
        if len(sentences) > 1:
            yield from map(words_of, sentences)
        if not _LEGAL.isdisjoint(words):
            legal.append(words)
        if legal and (legal[-1] is not words or k + 1 == len(paragraphs) or paragraphs[k + 1][0] != marked):
            if len(legal) > 1:
                yield [w for part in legal for w in part]
            legal = []
    yield everything


class NoticeMatcher:
    """Cosine of a part of a text with every template."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], total: int):
        self.idf = {t: math.log((1 + total) / (1 + n)) + 1 for t, n in frequency.items()}
        self.other = math.log(1 + total) + 1  # a term of no template weighs like one that never occurs
        self.names = [name for name, _ in templates]
        self.places: dict[bytes, list[tuple[int, float]]] = {}  # by term, the templates that hold it
        for k, (_, text) in enumerate(templates):
            weights = {t: n * self.idf[t] for t, n in Counter(words_of(text.encode())).items()}
            norm = math.sqrt(sum(w * w for w in weights.values()))
            for t, w in weights.items():
                self.places.setdefault(t, []).append((k, w / norm))

    def best(self, words: list[bytes], least: float = 0.0) -> tuple[float, str | None]:
        """The best template; (0, None) if the terms of all templates together do not reach ``least``."""
        known, square, unknown = [], 0.0, 0
        for t, n in Counter(words).items():
            w = self.idf.get(t)
            if w is None:
                unknown += n * n
            else:
                known.append((t, n * w))
                square += n * n * w * w
        norm = square + unknown * self.other * self.other
        if not known or square < least * least * norm * (1 - 1e-9):
            return 0.0, None
        dots = [0.0] * len(self.names)
        for t, w in known:
            for k, v in self.places[t]:
                dots[k] += w * v
        top, name = min((-d, name) for d, name in zip(dots, self.names))
        return -top / math.sqrt(norm), name

    def notice(self, text: bytes) -> tuple[float, str | None]:
        """Best match among the parts of a text."""
        best: tuple[float, str | None] = (0.0, None)
        for words in units(text):
            found = self.best(words, best[0])
            if found[1] is not None and (found[0] > best[0] or found[0] == best[0] and found[1] < (best[1] or "~")):
                best = found
        return best


def _match(matcher: NoticeMatcher, least: float):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "text", 4 << 20):
            own, scores = [], []
            for text in batch.column("text").to_pylist():
                value, name = matcher.notice(text)
                own.append(name if value >= least else None)
                scores.append(value)
            columns = [batch.column(c).combine_chunks() for c in ("doc_id", "path", "crc")]
            yield pa.record_batch([*columns, pa.array(own, pa.string()), pa.array(np.array(scores, float))], names=[f.split()[0] for f in FOUND.split(", ")])

    return match


def folder_of(path: Column) -> Column:
    """The folder of a path; the root is the empty string."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """A folder and all above it as (folder, depth)."""
    steps = F.split(folder, "/")
    depth = F.when(folder == "", 0).otherwise(F.size(steps))
    return F.transform(
        F.sequence(F.lit(0), depth), lambda d: F.struct(F.array_join(F.slice(steps, 1, d), "/").alias("above"), d.alias("depth"))
    )


def scan_licences(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "path",
    notices: dict[str, str] | None = None, file_names: tuple[str, ...] = FILE_NAMES, least: float = LEAST,
) -> DataFrame:
    """One row per row of ``df``: doc_id, path, licence, origin (notice, file, inherited, none), licence_path, score.

    ``notices`` take the place of all templates.
    """
    templates = list(notices.items()) if notices else all_templates(NOTICES)
    path = F.col(path_col).cast("string")
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), path.alias("path"), payload(text_col).alias("text"))
    terms = frozenset(t for _, text in templates for t in words_of(text.encode()))
    counted = docs.select("text").mapInArrow(_count(terms), "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequency = {bytes(r.term): r.n for r in counted.collect()}  # at most one row per template term
    total = frequency.pop(b"", 0)
    matcher = NoticeMatcher(templates, {t: frequency.get(t, 0) for t in terms}, total)
    found = cut_lineage(docs.withColumn("crc", F.crc32("text")).mapInArrow(_match(matcher, least), FOUND))
    found = found.withColumn("folder", folder_of(F.col("path")))
    name = F.element_at(F.split("path", "/"), -1)
    files = found.where(F.col("own").isNotNull() & name.isin(list(file_names))).groupBy("folder").agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("own").alias("licence"), F.col("path").alias("licence_path"))).alias("best")
    )
    files = files.select(F.col("folder").alias("above"), "best.licence", "best.licence_path")
    folders = found.where(F.col("folder").isNotNull()).select("folder").distinct()
    nearest = (
        folders.select("folder", F.inline(ancestors(F.col("folder")))).join(files, "above")
        .groupBy("folder").agg(F.max(F.struct("depth", "licence", "licence_path")).alias("n"))
        .select("folder", F.col("n.licence").alias("given"), F.col("n.licence_path").alias("given_path"))
    )
    out = found.join(nearest, "folder", "left")
    origin = (
        F.when(F.col("own").isNotNull() & F.coalesce(name.isin(list(file_names)), F.lit(False)), "file").when(F.col("own").isNotNull(), "notice")
        .when(F.col("given").isNotNull(), "inherited").otherwise("none")
    )
    return out.select(
        "doc_id", "path", F.coalesce("own", "given").alias("licence"), origin.alias("origin"),
        F.when(F.col("own").isNull(), F.col("given_path")).otherwise(F.col("path")).alias("licence_path"), "score",
    )
