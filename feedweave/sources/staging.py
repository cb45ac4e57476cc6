"""Tables staged by day, of which a run over a few days reads only the files of those days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import DATE_PATTERN

# The folder level. The letter keeps days text; rows whose text is no day lie together in a folder of their own.
DAY, NO_DAY = "__day", "none"


def _folder_name(c: Column) -> Column:
    exact = F.try_to_timestamp(c, F.lit(DATE_PATTERN)).isNotNull() & c.rlike("^[0-9]{8}$")
    return F.when(exact, F.concat(F.lit("d"), c)).otherwise(F.lit(NO_DAY))


def stage_by_day(df: DataFrame, path: str, day: str) -> None:
    """Write Parquet with one folder for each day of the raw ``yyyyMMdd`` column, replacing the days that occur.

    Every row is kept, with its raw text. Rows are dealt by day so that a day has few files; Spark splits a
    day that is much larger than others over several tasks and merges small ones.
    """
    dealt = df.withColumn(DAY, _folder_name(F.col(day))).hint("rebalance", DAY)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, schema: T.StructType, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of the days from ``first`` to ``last``, both included; other days' files are not opened."""
    low, high = (f"d{x.strftime('%Y%m%d')}" for x in (first, last))
    staged = spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.StringType())])).parquet(path)
    return staged.filter(F.col(DAY).between(low, high)).drop(DAY)
