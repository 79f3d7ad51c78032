"""Joins and ordered scans that hold at any size and under skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.context import cut_lineage
from corridor_metrics.functions.measures import drop_null_keys

WINDOW_ROWS = 200_000
RANGE_ROWS = 1_000_000
SALTS = 32
HOT_SHARE = 1000


_COUNTS: WeakKeyDictionary = WeakKeyDictionary()


def counted(df: DataFrame) -> int:
    """Number of rows, before they may be ordered in one task.

    The count is combined per task and needs no columns, so it is safe to ask of any
    frame. It is remembered with the frame, which reads the same files each time.
    """
    if df not in _COUNTS:
        _COUNTS[df] = df.count()
    return _COUNTS[df]


def checked_join(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join a large side with a side of any size; building the plan runs no job.

    Adaptive execution measures the finished stages: it broadcasts ``dim`` if its bytes
    are below the broadcast threshold, and otherwise splits the skewed partitions of
    ``fact``. Where it is switched off, hot keys are spread by hand. ``how`` is
    ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    if fact.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return fact.join(dim, list(on), how)
    return spread_join(fact, dim, on, how)


def hot_keys(df: DataFrame, on: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than one ``share``-th of all rows: fewer than ``share`` of them."""
    counts = drop_null_keys(df, *on).groupBy(*on).agg(F.count("*").alias("_n"))
    return counts.where(F.col("_n") * share > df.agg(F.count("*")).scalar()).select(*on, F.lit(True).alias("_hot"))


def spread_join(
    fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS, share: int = HOT_SHARE
) -> DataFrame:
    """Shuffled join in which every hot key of ``fact`` is spread over ``salts`` tasks.

    Only the ``dim`` rows of hot keys are copied. The salt is a hash of the row, so a
    task that runs again gives the same answer. Incomplete keys match nothing and are
    spread as well.
    """
    on = list(on)
    hot = F.broadcast(hot_keys(fact, on, share))
    salt = F.pmod(F.xxhash64(*fact.columns), F.lit(salts).cast("long"))
    lone = F.lit(0).cast("long")
    incomplete = reduce(or_, [F.col(k).isNull() for k in on])
    left = fact.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot") | incomplete, salt).otherwise(lone))
    copies = F.when(F.col("_hot"), F.sequence(lone, F.lit(salts - 1).cast("long"))).otherwise(F.array(lone))
    right = dim.join(hot, on, "left").withColumn("_salt", F.explode(copies))
    return left.drop("_hot").join(right.drop("_hot"), [*on, "_salt"], how).drop("_salt")


def _ranges(frame: DataFrame, key: str, parts: int | None) -> DataFrame:
    """Cut a frame into key ranges of about ``RANGE_ROWS`` rows; the checkpoint fixes the cut."""
    parts = parts or max(2, counted(frame) // RANGE_ROWS)
    return cut_lineage(frame.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()))


def row_numbers(
    frame: DataFrame, key: str, name: str, max_rows: int = WINDOW_ROWS, parts: int | None = None
) -> DataFrame:
    """1-based position of every row in the order of a unique ``key``."""
    if counted(frame) <= max_rows:
        return frame.withColumn(name, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key)).cast("long"))
    ranged = _ranges(frame, key, parts)
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .count()
        .select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return (
        ranged.withColumn(name, local)
        .join(F.broadcast(offsets), ["_range"])
        .withColumn(name, (F.col(name) + F.col("_offset")).cast("long"))
        .drop("_range", "_offset")
    )


def lag_over_frame(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Value of the preceding row in the total order ``order`` of the whole frame.

    ``order`` must identify a row. Rows meet by all its columns but the last, and look back inside that block. Block ends
    are a smaller frame with the same question, ordered by one column less; it is answered in the same way,
    up to one row per value of the first column, which is sorted as a whole. So
    with (period, signal, detector) no task holds more than the detectors of a signal and
    period, the signals of a period, or the periods. Both sides read the one shuffle of the rows, unless a later
    step drops columns; building the plan runs no job. An order of one column is sorted as a whole.
    """
    if len(order) == 1:
        return df.withColumn(name, F.lag(value).over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    outer = order[:-1]
    rows = df.withColumn("_block", F.struct(*outer)).repartition("_block")
    inside = Window.partitionBy("_block").orderBy(order[-1])
    # the whole last row, so that both sides read the same columns and share the shuffle
    ends = rows.groupBy("_block").agg(F.max_by(F.struct(*df.columns), F.struct(order[-1])).alias("_end"))
    keys = [f"_outer{n}" for n in range(len(outer))]
    ends = ends.select(F.col("_block").alias("_of"), F.struct(F.col(f"_end.{value}").alias("v")).alias("_end"), *[F.col(f"_block.{c}").alias(k) for c, k in zip(outer, keys)])
    before = lag_over_frame(ends, keys, "_end", "_last").select(F.col("_of").alias("_block"), F.col("_last.v").alias("_carried"))
    return (
        rows.withColumn("_first", F.row_number().over(inside) == 1)
        .withColumn(name, F.lag(value).over(inside))
        .join(before, ["_block"], "left")
        .withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col(name)))
        .select(*df.columns, name)
    )


def lag_in_blocks(
    df: DataFrame, entity: Sequence[str], block: str, order: str, value: str, name: str
) -> DataFrame:
    """Preceding value of each entity without holding an entity in one task.

    ``block`` is a coarsening of ``order`` (say, the date). The rows are shuffled
    once, on entity and block. First rows of a block take the last value of the
    entity's block before, from a frame with one row per entity and block. The
    keys must not be NULL.
    """
    keys = [*entity, block]
    inside = Window.partitionBy(*keys).orderBy(order)
    carry = (
        df.groupBy(*keys)
        .agg(F.max_by(value, order).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*entity).orderBy(block)))
        .drop("_last")
    )
    rows = df.withColumn("_first", F.row_number().over(inside) == 1).withColumn(name, F.lag(value).over(inside))
    return (
        rows.join(carry, keys, "left")
        .withColumn(name, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(name)))
        .drop("_first", "_carry")
    )


def as_of_join(
    rows: DataFrame, history: DataFrame, keys: Sequence[str], on: str, values: Sequence[str], unit: str = "month"
) -> DataFrame:
    """Each row with the ``values`` of the last row of ``history`` that has its keys and is not later in ``on``, a date or time.

    Every date is answered at once: both sides are put together and the last values are carried forward. This runs per
    key and ``unit`` of time, and over units on a frame with one row for each, so that no task holds the history
    of a key. Of history rows of one key and time the greatest values count. Rows without an earlier history row, or
    with an incomplete key or time, have NULLs.
    """
    keys = list(keys)
    known = drop_null_keys(history, *keys, on).groupBy(*keys, on).agg(F.max(F.struct(*values)).alias("_value"))
    nothing = F.lit(None).cast(known.schema["_value"].dataType)
    complete = reduce(and_, [F.col(k).isNotNull() for k in [*keys, on]])
    asked = rows.where(complete).select(*keys, on, F.lit(1).alias("_side"), F.struct(*rows.columns).alias("_row"), nothing.alias("_value"))
    given = known.select(*keys, on, F.lit(0).alias("_side"), F.lit(None).cast(asked.schema["_row"].dataType).alias("_row"), "_value")
    both = asked.unionByName(given).withColumn("_unit", F.date_trunc(unit, F.col(on).cast("timestamp_ntz")))
    inside = Window.partitionBy(*keys, "_unit").orderBy(on, "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        both.groupBy(*keys, "_unit")
        .agg(F.max_by("_value", F.when(F.col("_side") == 0, F.col(on))).alias("_closing"))
        .withColumn("_carried", F.last("_closing", ignorenulls=True).over(earlier))
        .drop("_closing")
    )
    found = (
        both.withColumn("_value", F.last("_value", ignorenulls=True).over(inside))
        .where(F.col("_side") == 1)
        .join(carried, [*keys, "_unit"], "left")
        .withColumn("_value", F.coalesce("_value", "_carried"))
    )
    out = found.select("_row.*", *[F.col(f"_value.{v}").alias(v) for v in values])
    missing = rows.where(~complete).select("*", *[F.lit(None).cast(history.schema[v].dataType).alias(v) for v in values])
    return out.unionByName(missing)
