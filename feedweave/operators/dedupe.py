"""Deterministic deduplication and latest-row selection.

Both use ``row_number() = 1``, for which Spark cuts every map task's output to
one row per key before the shuffle, so a hot key never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank")


def dedupe_keys(df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per key. The survivor is the least by ``tie_break``, nulls last.

    By default all other columns break ties, so equal inputs give equal outputs.
    """
    rest = list(tie_break) if tie_break is not None else [c for c in df.columns if c not in set(keys)]
    if not rest:
        return df.dropDuplicates(list(keys))
    return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in rest])


def latest_per_key(df: DataFrame, keys: Sequence[str], time_column: str, tie_break: Sequence[str]) -> DataFrame:
    """The newest row per key; equal times are settled by ``tie_break``, descending."""
    order = [F.col(time_column).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    return first_per_key(df, keys, order)
