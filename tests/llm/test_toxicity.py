import random
import zlib

import pytest
from pyspark.sql import functions as F

from feedweave.llm import toxicity

STEMS = ["grumblex", "vornate"]


def corpus(n, seed=1):
    rng = random.Random(seed)
    syllables = ["ba", "le", "mor", "ti", "sen", "ga", "ru", "po", "lin", "da"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(20, 150))]
        toxic = int(k % 5 == 0)
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(STEMS) + word())
        rows.append((k, " ".join(words).capitalize(), toxic))
    return rows


@pytest.fixture(scope="module")
def learnt(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(k, t, None, "x") for k, t, _ in rows], "doc_id long, text string, score string, y string")
    labels = spark.createDataFrame([(k, y, 1 - y) for k, _, y in rows], "doc_id long, toxic int, y int")
    return rows, docs, toxicity.train(docs, labels)


def test_held_out_documents(learnt):
    rows, docs, model = learnt
    scored = {r["doc_id"]: r for r in toxicity.with_score(docs, model).withColumn("out", toxicity.is_held_out(F.col("doc_id"))).collect()}
    held = [(k, y) for k, _, y in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert {k for k, _ in held} == {k for k, r in scored.items() if r["out"]}
    right = sum((scored[k]["score"] >= toxicity.THRESHOLD) == bool(y) for k, y in held)
    assert right / len(held) > 0.97
    assert all(scored[k]["score"] < toxicity.THRESHOLD for k, y in held if not y)


def test_held_out_labels_are_not_learnt(spark, learnt):
    """Wrong labels on held-out rows change nothing."""
    rows, docs, model = learnt
    turned = [(k, 1 - y if zlib.crc32(str(k).encode()) % 3 == 1 else y) for k, _, y in rows]
    again = toxicity.train(docs, spark.createDataFrame(turned, "doc_id long, toxic int"))
    assert (again.buckets == model.buckets).all() and (again.weights == model.weights).all()


def test_odd_texts_have_scores(spark, learnt):
    _, _, model = learnt
    texts = [None, "", "   \n", "x", "é" * 10, "grumblexba " * 3, "same", "same", "z" * 400_000]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    scores = [r["score"] for r in toxicity.with_score(df, model).orderBy("doc_id").collect()]
    assert all(0 <= s <= 1 for s in scores)
    assert scores[0] == scores[1] == scores[2] < toxicity.THRESHOLD
    assert scores[6] == scores[7]


def test_odd_labels(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(9)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(0, 1), (2, 1), (None, 0), (3, None)], "doc_id long, toxic int")):
        model = toxicity.train(docs, labels)
        assert {r["score"] for r in toxicity.with_score(docs, model).collect()} == {0.5}
    assert toxicity.with_score(docs.where("false"), model).count() == 0
    both = spark.createDataFrame([(0, 1), (0, 0), (0, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    chosen = {r["t"]: r["y"] for r in toxicity.training_rows(docs, both, "doc_id", "text", "toxic", 100).collect()}
    known = {0: 1, 2: 0, 3: 0}
    assert chosen == {f"text {k}": y for k, y in known.items() if zlib.crc32(str(k).encode()) % 3 != 1}
    assert toxicity.training_rows(docs, both, "doc_id", "text", "toxic", 1).count() == 1
