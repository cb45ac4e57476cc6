"""Helpers shared by the corpus operators: lineage cuts, graph components, gapless numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedweave.session import scratch_path

# Rows handed to a Python worker at once. Texts may be long, so batches stay short.
ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of texts, pages or vectors holds in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by rows and by bytes: a batch ends at the first row that reaches either."""
    small_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it again.

    This cuts the lineage at a table that outlives executors; a later stage
    rereads it instead of computing it once more.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"),
    ).first()
    return row["n"], int(row["s"] or 0)


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Label every node that has an edge with the smallest node it can reach.

    Alternates the large-star and small-star steps until the edge set no longer
    changes; the number of rounds grows with the logarithm of the longest path.
    Minima are pre-aggregated, and the joins that hand them out can be split by
    adaptive execution, so a node with very many edges is no bottleneck. The
    edges of every round are a table in the shared folder. Edges with a null end
    and loops are ignored; repeated edges count once. Returns ``node`` and
    ``component``; nodes without edges do not appear.
    """
    e = edges.select(F.col(src).cast("long").alias("a"), F.col(dst).cast("long").alias("b"))
    e = e.where("a is not null and b is not null and a <> b")
    e = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialise(e, "edges")
    before = _mark(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialise(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _mark(e)
        if now == before:
            break
        before = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return stars.union(roots)


def slice_key(col: Column) -> Column:
    """One of 4096 slices of a key, even for any distribution of the key itself."""
    return F.substring(F.md5(F.coalesce(col.cast("string"), F.lit(""))), 1, 3)


def number_in_group(df: DataFrame, group: str, key: str, ties: list[Column], out: str) -> DataFrame:
    """Gapless numbers from 0 within each group, without one task per group.

    Rows are ordered by the slice of ``key``, then ``key``, then ``ties``. Each
    (group, slice) is numbered by a window of its own and shifted by the row
    counts of the slices before it; that table has at most 4096 rows a group. The
    group must be bounded in number and hold no null.
    """
    cut, shift = "__slice", "__shift"
    sliced = df.withColumn(cut, slice_key(F.col(key)))
    before = Window.partitionBy(group).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        sliced.groupBy(group, cut)
        .agg(F.count("*").alias("__n"))
        .withColumn(shift, F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .select(F.col(group).alias("__g"), F.col(cut).alias("__s"), shift)
    )
    own = Window.partitionBy(group, cut).orderBy(F.col(key).asc_nulls_first(), *ties)
    numbered = sliced.withColumn("__row", F.row_number().over(own))
    joined = numbered.join(shifts, (F.col(group) == F.col("__g")) & (F.col(cut) == F.col("__s")))
    return joined.withColumn(out, (F.col("__row") - 1 + F.col(shift)).cast("long")).drop(
        cut, shift, "__row", "__g", "__s"
    )
