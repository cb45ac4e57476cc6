"""Toxicity: character n-gram linear classifier over naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from feedweave.llm.common import materialise, small_batches

ORDERS = (4, 5, 6)
BUCKET_BITS = 20
THRESHOLD = 0.7
# Labelled rows the classifier is fitted on at most, and features it may use.
SAMPLE_ROWS = 30_000
FEATURES = 5_000


@dataclass(frozen=True)
class Model:
    """Buckets with their weights (log-count ratio times coefficient) and the offset."""

    buckets: np.ndarray
    weights: np.ndarray
    offset: float

    def table(self) -> np.ndarray:
        full = np.zeros(1 << BUCKET_BITS, np.float32)
        full[self.buckets] = self.weights
        return full


def ngram_buckets(text: str | None) -> list[np.ndarray]:
    """Hash buckets of all character n-grams of the whole text, one array per order.

    The text is lower-cased, runs of white space become one blank, and a blank
    stands at both ends, so that n-grams see where words begin and end.
    """
    line = f" {' '.join((text or '').split()).lower()} "
    chars = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
    found, rolling = [], chars.copy()
    for n in range(2, max(ORDERS) + 1):
        if len(chars) < n:
            break
        rolling = rolling[:-1] * np.uint32(0x01000193) + chars[n - 1 :]
        if n in ORDERS:
            mixed = rolling ^ (rolling >> np.uint32(15))
            found.append((mixed * np.uint32(0x9E3779B1) + np.uint32(n)) >> np.uint32(32 - BUCKET_BITS))
    return found


def present(text: str | None, wanted: np.ndarray) -> np.ndarray:
    """The wanted buckets that occur in the text, each once, in ascending order."""
    hits = [b[wanted[b]] for b in ngram_buckets(text)]
    return np.unique(np.concatenate(hits)) if hits else np.empty(0, np.uint32)


def is_held_out(doc_id: Column) -> Column:
    """True for the rows no label is learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, sample_rows: int) -> DataFrame:
    """Texts of at most ``sample_rows`` labelled ids, ``y`` 1 or 0.

    Labels that contradict each other for one id are settled by their majority,
    ties as 1. The sample takes the ids with the smallest hash, so it depends on
    ids alone; its size bound makes it safe to broadcast.
    """
    votes = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("__id"))
        .agg((F.avg((F.col(label) != 0).cast("int")) >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("__id"), "__id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text).alias("t"))
    return texts.join(F.broadcast(votes), F.col("__doc") == F.col("__id")).select("t", "y")


def _class_counts(rows: DataFrame) -> pd.DataFrame:
    """Documents of each class that hold a bucket: at most 2**BUCKET_BITS rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for buckets in [np.unique(np.concatenate(b)) for b in [ngram_buckets(text)] if b]:
                    seen[y, buckets] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[1, at]), pa.array(seen[0, at])], names=["b", "p", "n"])

    total = rows.mapInArrow(count, "b long, p int, n int").groupBy("b").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    return total.where("p + n >= 3")


def _fit(ids: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, l2: float, rounds: int) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows whose present features have the value of their ratio."""
    flat = np.concatenate([*ids, np.empty(0, np.int64)]).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    value = ratio[flat]
    # each class weighs the same, and the step suits the largest row
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    norm = np.bincount(row, value * value, minlength=len(ids))
    step = 1.0 / (0.25 * (1 + float((share * norm).sum())) + l2)
    w, b = np.zeros(len(ratio)), 0.0
    w_ahead, b_ahead, t = w, b, 1.0
    for _ in range(rounds):
        margin = np.bincount(row, value * w_ahead[flat], minlength=len(ids)) + b_ahead
        error = share * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y)
        grad = np.bincount(flat, value * error[row], minlength=len(ratio)) + l2 * w_ahead
        w_next, b_next = w_ahead - step * grad, b_ahead - step * error.sum()
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        w_ahead = w_next + (t - 1) / t_next * (w_next - w)
        b_ahead = b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return w, b


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    smoothing: float = 1.0,
    l2: float = 1e-5,
    rounds: int = 400,
) -> Model:
    """Fit the classifier on a bounded sample of the labelled rows that are not held out.

    Executors count in how many documents of each class every hashed n-gram
    occurs; its log-count ratio is the feature's value. The ``features`` n-grams
    whose presence tells most about the class (G statistic) are kept, executors
    turn the sample into lists of them, and the driver fits the coefficients on
    these lists, both bounded by ``sample_rows`` and ``features``. Without labels of both
    classes there is nothing to learn: every score is then 0.5.
    """
    small_batches(docs.sparkSession)
    rows = materialise(training_rows(docs, labels, id_col, text, label, sample_rows), "labelled")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(np.empty(0, np.int64), np.empty(0, np.float32), 0.0)
    n_pos, n_neg = sizes[1], sizes[0]

    def g_part(seen: Column, size: int) -> Column:
        expected = F.lit(float(size)) * (F.col("p") + F.col("n")) / float(n_pos + n_neg)
        absent = F.lit(float(size)) - seen
        absent_expected = F.lit(float(size)) - expected
        term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
        return term(seen, expected) + term(absent, absent_expected)

    top = (
        _class_counts(rows)
        .withColumn("g", g_part(F.col("p"), n_pos) + g_part(F.col("n"), n_neg))
        .orderBy(F.desc("g"), "b")
        .limit(features)
        .collect()
    )
    top.sort(key=lambda r: r["b"])
    buckets = np.array([r["b"] for r in top], np.int64)
    p = np.array([r["p"] for r in top], float)
    n = np.array([r["n"] for r in top], float)
    ratio = np.log((p + smoothing) / (n_pos + 2 * smoothing)) - np.log((n + smoothing) / (n_neg + 2 * smoothing))
    wanted = np.zeros(1 << BUCKET_BITS, bool)
    wanted[buckets] = True

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.searchsorted(buckets, present(t, wanted)).astype(np.int32) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([i.tobytes() for i in ids], pa.binary()), batch.column(1)], names=["ids", "y"])

    ids, y = [], []
    for r in rows.mapInArrow(lists, "ids binary, y int").collect():
        ids.append(np.frombuffer(r["ids"], np.int32))
        y.append(r["y"])
    w, offset = _fit(ids, np.array(y, float), ratio, l2, rounds)
    return Model(buckets, (w * ratio).astype(np.float32), float(offset))


def with_score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """Add the probability (0 to 1) that a whole text is toxic; null and empty texts score by the offset alone.

    Repeated rows score alike. An existing column called ``out`` is replaced.
    """
    small_batches(docs.sparkSession)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = model.table()
        wanted = weights != 0
        for batch in texts:
            sums = np.array([weights[present(t, wanted)].sum(dtype=np.float64) for t in batch], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums + model.offset, -40, 40))))

    return docs.withColumn(out, score(F.col(text)))
