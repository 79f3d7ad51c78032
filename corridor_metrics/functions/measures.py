"""Null-safe ratios and weighted means."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den``; NULL when the divisor is 0 (also in ANSI mode)."""
    return F.try_divide(num, den)


def total(c: Column | str) -> Column:
    """Sum in which a group without values counts 0."""
    return F.coalesce(F.sum(c), F.lit(0))


def weighted_mean(value: str, weight: str) -> list[Column]:
    """The aggregates Σ(v·w)/Σw and Σw.

    A NULL value drops out of the numerator, while its weight stays in the divisor.
    """
    v, w = F.col(value).cast("double"), F.col(weight).cast("double")
    return [ratio(total(v * w), total(w)).alias(value), total(w).alias(weight)]


def relative_change(value: Column, previous: Column) -> Column:
    return ratio(value - previous, previous)


def drop_null_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Groups are built from complete keys only; the conditions reach the Parquet scan."""
    return df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
