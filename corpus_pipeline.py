"""The corpus pipeline: toxicity, near duplicates, source mix, tokens.

Each stage takes the documents its predecessor kept and is written as Parquet
before the next one reads it. The mix is the order of the rows in the files of the third
stage; the last one carries it as ``position``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedweave.llm import bpe, mixing, simhash, toxicity
from feedweave.llm.catalog import BIT_DISTANCE, OTHER_WEIGHT, PATTERN, RANKS, SHINGLE_WORDS, TARGET_WEIGHTS
from feedweave.llm.common import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose toxicity score reaches the threshold; learnt from this stage's documents."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_score(docs.select(*COLUMNS), model, out="__score")
    return scored.where(F.col("__score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group."""
    return simhash.keep_first(docs.select(*COLUMNS), shingle_words=SHINGLE_WORDS, distance=BIT_DISTANCE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order in which the sources mix to their target weights."""
    return mixing.in_mixed_order(docs.select(*COLUMNS), TARGET_WEIGHTS, other_weight=OTHER_WEIGHT)


def with_position(docs: DataFrame) -> DataFrame:
    """Add ``position``: the place of every row in the order in which its Parquet files were written, gapless from 0.

    Sorted rows lie in part files by part number, and within a file by row. A reader packs files
    by size, so the order of its rows says nothing.
    """
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    placed = docs.select("*", part.alias("__part"), F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    sizes = placed.groupBy("__part", "__file").agg(F.count("*").alias("__n"))
    # one row for each part file
    before = Window.orderBy("__part", "__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("__file").alias("__f"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    joined = placed.join(F.broadcast(starts), F.col("__file") == F.col("__f"))
    return joined.select(*docs.columns, (F.col("__start") + F.col("__row")).alias("position"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, its position in the mix, and the digests that show the exact round trip."""
    return bpe.round_trip(with_position(docs).select("doc_id", "position", "text"), RANKS, PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenise),
]

# The fitted classifier, the fingerprints and the tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
