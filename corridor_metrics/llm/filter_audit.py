"""How the filters of a cleaning chain interact, for every order they may run in.

A filter is a condition under which a document fails. The documents are counted by the set of filters they
fail; from these counts the number that a coalition of filters removes together is tabulated for all
``2 ** n`` coalitions (32 for five). Everything else follows from that table of fixed size:

* what a filter removes at a step is the removal of the coalition up to it less that of the coalition before it,
  and so are the good and toxic documents lost there;
* Shapley values come from a weighted least-squares fit: over all coalitions that are neither empty nor whole, the sum of
  the members' values shall be near the removal, weighted with the kernel ``(n - 1) / (C(n, k) k (n - k))`` for size ``k``, and the values
  of all filters add up to the removal of the whole chain. The normal equations with that constraint are
  solved in rational numbers, so the result is exact; a solution that is no multiple of ``1 / n!`` is an error.

Shuffles: equal texts meet by length and SHA-256, counted per task first, so that a group of copies of
any size is one row per task and id; labels meet documents by id. The counts per part are one row per
coalition, and only these leave Spark's own functions.

Defined results: a NULL text is empty, a NULL part is the empty string; a NULL id is smaller than no id and no id is
smaller than it; rows that repeat an id and a text are not copies of each other; a document is good or toxic if any
label row of its id says so; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial
from operator import add

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The bounds of the four conditions on a text alone.
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the code points
SYMBOLS = "[#$%&*|]"
COUNTED = ("rows", "good", "toxic")


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions that need the text only, by letter."""
    words = F.filter(F.split(F.translate(text, "\t\n\x0b\x0c\r", "     "), " "), lambda w: w != "")
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": distinct * 100 < F.size(words) * LEAST_DISTINCT,
        "C": capitals * 100 > F.length(text) * MOST_CAPITALS,
        "D": text.rlike(SYMBOLS),
    }


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Documents by part and the set of filters they fail: part, mask, rows, good, toxic.

    Bit ``k`` of ``mask`` stands for the ``k``-th letter; copies of a smaller id have the fifth bit.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    conditions = text_failures(text)
    mask = reduce(add, [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(conditions.values())])
    marks = labels.groupBy(F.col(id_col).cast("long").alias("_label_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    seen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"), F.octet_length(text).alias("size"), digest.alias("digest"),
    )
    per_id = seen.groupBy("doc_id", "part", "mask", "size", "digest").agg(F.count("*").alias("n"))
    marked = per_id.join(marks, F.col("doc_id") == F.col("_label_id"), "left").fillna(False, ["good", "toxic"])
    unnamed = F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    per_text = marked.groupBy("size", "digest", "mask", "part", "good", "toxic").agg(F.sum("n").alias("n"), unnamed.alias("unnamed"), least.alias("least"))
    of_text = Window.partitionBy("size", "digest")
    first = F.when(F.col("least.doc_id") == F.min("least.doc_id").over(of_text), F.col("least.n")).otherwise(F.lit(0))
    copy_bit = F.lit(1 << len(conditions))
    split = per_text.withColumn("own", first + F.col("unnamed")).select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask"), F.col("own").alias("n")),
            F.struct(F.col("mask").bitwiseOR(copy_bit).alias("mask"), (F.col("n") - F.col("own")).alias("n")),
        )),
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def coalition_removals(counts: DataFrame, filters: int) -> DataFrame:
    """One row per part: ``total`` documents, and ``removals`` of every coalition in the order of its bits (rows, good, toxic)."""
    coalitions = F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1)))
    gone = (F.col("mask").bitwiseAND(F.col("coalition")) != 0).cast("long")
    table = counts.withColumn("coalition", coalitions).groupBy("part", "coalition").agg(
        F.sum("rows").alias("total"), *[F.sum(F.col(c) * gone).alias(c) for c in COUNTED]
    )
    return table.groupBy("part").agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("coalition", *COUNTED))).alias("removals")
    )


def solve(matrix: list[list[Fraction]], right: list[Fraction]) -> list[Fraction]:
    """Solution of a regular system in rational numbers, by elimination."""
    rows = [[*row, value] for row, value in zip(matrix, right)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i, row in enumerate(rows):
            if i != k and row[k]:
                rows[i] = [x - row[k] * y for x, y in zip(row, rows[k])]
    return [row[-1] for row in rows]


def shapley_values(removal: list[int], filters: int) -> list[Fraction]:
    """Shapley value of each filter from the removals of all coalitions, by least squares.

    The multiplier of the constraint is the last unknown of the system.
    """
    whole = (1 << filters) - 1
    matrix = [[Fraction(0)] * filters + [Fraction(1)] for _ in range(filters)] + [[Fraction(1)] * filters + [Fraction(0)]]
    right = [Fraction(0)] * filters + [Fraction(removal[whole])]
    for coalition in range(1, whole):
        members = [k for k in range(filters) if coalition >> k & 1]
        weight = Fraction(filters - 1, comb(filters, len(members)) * len(members) * (filters - len(members)))
        for i in members:
            right[i] += weight * removal[coalition]
            for k in members:
                matrix[i][k] += weight
    return solve(matrix, right)[:-1]


def order_steps(letters: str, total: int, removals: list[Mapping[str, int]]) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every step of every order."""
    n = len(letters)
    whole = (1 << n) - 1
    rows, good, toxic = ([r[c] for r in removals] for c in COUNTED)
    scaled = [value * factorial(n) for value in shapley_values(rows, n)]
    if any(value.denominator != 1 for value in scaled):
        raise ArithmeticError(f"values are no multiples of 1/{factorial(n)}: {scaled}")
    for order in permutations(range(n)):
        before = 0
        for step, k in enumerate(order, 1):
            after = before | 1 << k
            removed = rows[after] - rows[before]
            yield (
                "".join(letters[i] for i in order), step, total - rows[after], removed, rows[1 << k] - removed,
                rows[whole] - rows[whole ^ 1 << k], good[after] - good[before], toxic[after] - toxic[before], scaled[k].numerator,
            )
            before = after


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """Every step of every order of the filters, by part; ``counts`` as from ``failure_counts``, bit ``k`` for the ``k``-th letter."""
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()), *[(c, pa.int64()) for c in COUNTS]])

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = zip(*[(row["part"], *step) for step in order_steps(letters, row["total"], row["removals"])])
                yield pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(columns, schema)], schema=schema)

    types = ", ".join(f"{c} long" for c in COUNTS)
    return coalition_removals(counts, len(letters)).mapInArrow(steps, f"part string, filter_order string, step int, {types}")


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """The audit of the five filters over a table of documents."""
    return audit(failure_counts(docs, labels, id_col, text_col, part_col))
