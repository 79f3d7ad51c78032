"""Exact percentiles of groups of any size, without a buffer that holds the values of a group.

The values are counted first. A histogram of each group says in which bin the wanted rank lies; only the
values of that bin are looked at again, and the rank within them is found by a running count. Histogram and
counts are rows of ordinary aggregations, which are combined per task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corridor_metrics.operators.scale import checked_join

RESOLUTION = 2000
NO_BIN = -(1 << 62)


def _bin(value: Column, resolution: int) -> Column:
    """Number of a bin whose width is about ``1 / resolution`` of the values in it; a value that is not smaller is in no smaller bin."""
    number = F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(resolution)).cast("long")
    return F.coalesce(number, F.lit(NO_BIN))  # complete, so that both reads of the counts stay the same


def _at_rank(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of each group in which its running ``_n`` passes ``_rank``, with the ranks before it in ``_below``.

    The one row of a group without values stays.
    """
    ordered = Window.partitionBy(*keys).orderBy(order)
    so_far = F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        rows.withColumn("_upto", so_far)
        .withColumn("_later", F.coalesce(F.lead("_low").over(ordered), F.col("_next")))
        .withColumn("_below", F.col("_upto") - F.col("_n"))
        .where((F.col("_total") == 0) | ((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto"))))
    )


def grouped_percentile(
    counted: DataFrame, keys: Sequence[str], value: str, count: str, share: float, name: str, resolution: int = RESOLUTION
) -> DataFrame:
    """Percentile with linear interpolation of each group, from its distinct values and how often each occurs.

    ``counted`` has one row per group and value. The histogram has bins of equal ratio, so it needs no range; a window runs over its
    bins, another over the values of one bin. NULL values don't count; a group without others has a NULL percentile.
    The keys must be complete, and values finite.
    """
    keys = list(keys)
    number = F.col(value).cast("double")
    values = counted.select(*keys, number.alias("_value"), F.col(count).alias("_count"), _bin(number, resolution).alias("_bin"))
    histogram = values.groupBy(*keys, "_bin").agg(
        F.sum(F.when(F.col("_value").isNotNull(), F.col("_count")).otherwise(0)).alias("_n"), F.min("_value").alias("_low")
    )
    group = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = histogram.withColumn("_total", F.sum("_n").over(group))
    placed = placed.withColumn("_place", (F.col("_total") - 1) * F.lit(float(share))).withColumns({"_rank": F.floor("_place"), "_next": F.lit(None).cast("double")})
    target = _at_rank(placed, keys, "_bin").select(
        *keys, "_bin", "_total", "_place", (F.col("_rank") - F.col("_below")).alias("_rank"), F.col("_later").alias("_next")
    )
    exact = checked_join(values, target, [*keys, "_bin"]).select(
        *keys, "_rank", "_next", "_total", "_place", F.col("_value").alias("_low"), F.col("_count").alias("_n")
    )
    found = _at_rank(exact, keys, "_low").withColumn(
        "_above", F.when(F.col("_rank") + 1 < F.col("_upto"), F.col("_low")).otherwise(F.col("_later"))
    )
    share_above = F.col("_place") - F.floor("_place")
    between = (F.ceil("_place") - F.col("_place")) * F.col("_low") + share_above * F.col("_above")
    result = F.when((share_above == 0) | (F.col("_low") == F.col("_above")), F.col("_low")).otherwise(between)
    return found.select(*keys, result.alias(name))
