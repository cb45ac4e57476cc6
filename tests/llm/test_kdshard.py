import random
import zlib

import pytest
from pyspark.sql import functions as F

from feedweave.llm import kdshard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text = "é" * rng.randint(0, 30) + "x" * int(rng.paretovariate(1.2) * 20 % 4000)
        source = "hot" if k % 3 == 0 else f"s{rng.randrange(9)}"
        rows.append((k, text, rng.choice(["en", "de", None]), source, len(text)))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_nearly_equal_bytes(spark, shards):
    rows = documents(900)
    found = kdshard.shard(spark.createDataFrame(rows, SCHEMA), shards=shards)
    placed = found.collect()
    assert len(placed) == len(rows)
    text = {r[0]: r[1] for r in rows}
    sizes, slots = {}, {}
    for r in placed:
        data = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(sizes) == list(range(shards))
    largest = max(r["size"] for r in placed)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_weighted_median_is_exact(spark):
    """One split: no other border between two keys comes closer to half of the bytes."""
    rows = documents(400, 3)
    docs = spark.createDataFrame(rows, SCHEMA)
    measured = kdshard.measured(docs, "doc_id", "text", ["n_chars"], [])
    keys = sorted((r["__d0"], r["__tie"], r["__size"]) for r in measured.collect())
    total, best, cum = sum(k[2] for k in keys), None, 0
    for k in [(None, None, 0), *keys]:
        cum += k[2]
        best = min(abs(cum - total // 2), total if best is None else best)
    halves = [r[1] for r in kdshard.shard(docs, shards=2, numbers=("n_chars",), names=()).groupBy("shard").agg(F.sum("size")).orderBy("shard").collect()]
    assert abs(halves[0] - total // 2) == best


def test_equal_metadata_still_splits(spark):
    rows = [(k, "the same text", "en", "hot", 13) for k in range(640)]
    counts = [r["count"] for r in kdshard.shard(spark.createDataFrame(rows, SCHEMA), shards=16).groupBy("shard").count().collect()]
    assert len(counts) == 16 and max(counts) - min(counts) <= 4


def test_target_bytes(spark):
    df = spark.createDataFrame(documents(500), SCHEMA)
    total = kdshard.shard(df, shards=1).agg(F.sum("size")).first()[0]
    assert kdshard.shard(df, shards=None, target_bytes=total // 6 + 1).select("shard").distinct().count() == 6


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", None, "a", 0), (1, "", None, "a", 0), (2, "long " * 60000, "en", "b", 300000), (3, "x", "en", "b", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"slot": F.lit("mine"), "Shard": F.lit(3)})
    found = kdshard.shard(df, shards=4)
    assert sorted(found.columns) == sorted(["doc_id", "text", "lang", "source", "n_chars", "shard", "slot", "size", "text_crc32"])
    placed = found.collect()
    assert len(placed) == len(rows) and {r["shard"] for r in placed} <= set(range(4))
    assert next(r for r in placed if r["doc_id"] is None)["size"] == 1
    assert kdshard.shard(df.where("false"), shards=4).count() == 0
