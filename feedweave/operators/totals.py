"""Aggregates of the purchase feed. All of them combine on the map side before shuffling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_on_struct

MONEY = "decimal(18,2)"


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def total_per_group(
    df: DataFrame, keys: Sequence[str], value: str, name: str, drop: Iterable[str] = (), within: Sequence[str] = ()
) -> DataFrame:
    """Give each distinct detail row the sum of ``value`` over its keys.

    ``value`` and the ``drop`` columns leave the detail, which is then distinct.
    The detail is collapsed first (map-side combine), the group totals are taken
    from the collapsed rows, and the two are joined on the keys. A window would
    put a whole hot group into one task; here adaptive execution may split it.

    ``within`` names columns by which the rows are dealt already and which the keys decide: groups then lie whole
    in one task each, without a shuffle, and a window over the collapsed rows of a group gives its total.
    """
    gone = {value, *drop}
    kept = [c for c in df.columns if c not in gone]
    collapsed = df.groupBy(*kept).agg(F.sum(value).alias("__part"))
    if set(kept) == set(keys):
        return collapsed.withColumnRenamed("__part", name)
    if within:
        group = Window.partitionBy(*dict.fromkeys([*within, *keys]))
        return collapsed.withColumn(name, F.sum("__part").over(group)).drop("__part")
    totals = collapsed.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.sum("__part").alias(name))
    joined = join_on_struct(collapsed, totals, {k: f"__{k}" for k in keys})
    # always true; because it names the partial sum, both inputs of the join collapse the same
    # columns, and Spark reads and shuffles the detail once for both
    joined = joined.filter(F.col("__part").isNull() | F.col(name).isNotNull())
    return joined.select(*[collapsed[c] for c in kept], name)


def daily_revenue(df: DataFrame, day: str, quantity: str, price: str) -> DataFrame:
    """Rows and revenue per day, in exact decimals."""
    amount = F.col(quantity).cast("decimal(12,0)") * F.col(price).cast(MONEY)
    return df.groupBy(day).agg(F.count("*").alias("count"), F.sum(amount).alias("total_sum"))


def daily_distinct(df: DataFrame, day: str, item: str, name: str) -> DataFrame:
    return df.groupBy(day).agg(F.count_distinct(F.col(item)).alias(name)).orderBy(day)


def daily_count(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(day).agg(F.count("*").alias("count"))


def leak_audit(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row, one pass: for each named condition the number of rows that still meet it."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
