import math
import random

import pytest
from pyspark.sql import functions as F

from feedweave.llm import topk

SCHEMA = "vec_id long, embedding array<float>, query_id long, rank string"


def brute(rows, k, scale, step):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(scale * x) for x in v]
        vectors[i] = min(v, vectors.get(i, v))
    found = []
    for q, v in vectors.items():
        if q % step == 0:
            scored = [(-sum(a * b for a, b in zip(v, w)), c) for c, w in vectors.items() if c != q and len(w) == len(v)]
            found += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found)


def made(spark, rows):
    return spark.createDataFrame([(i, v, 3, "old") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("dim, spread", [(2, 0.02), (16, 1.0), (64, 0.2)])
def test_equals_brute_force(spark, monkeypatch, dim, spread):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 150)
    monkeypatch.setattr(topk, "QUERY_ROWS", 20)
    monkeypatch.setattr(topk, "LEAF", 8)
    rng = random.Random(dim)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(k, [x + rng.gauss(0, spread) for x in rng.choice(centres)]) for k in range(700)]
    rows += [(700 + k, rows[7][1]) for k in range(60)]  # equal vectors: ties by id
    rows = [(i, [float(F_) for F_ in v]) for i, v in rows]
    df = made(spark, rows)
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = topk.top_k(df, F.col("id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(exact, 20, 64, 20)


def test_only_balls_that_can_reach_are_opened(spark, monkeypatch):
    """Balls cover what lies below them, several levels deep; far clusters give no row for a pair of blocks."""
    import numpy as np

    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "BLOCK_BYTES", 128)
    monkeypatch.setattr(topk, "FAN_BITS", 1)
    monkeypatch.setattr(topk, "PIVOTS", 10)
    written, keep, covering = {}, topk.materialise, topk._levels

    def noted(df, label):
        written[label] = keep(df, label)
        return written[label]

    def checked(trees):
        levels = covering(trees)
        assert len(levels) > 4 and levels[-1].count() == 1
        for low, high in zip(levels, levels[1:]):
            balls = {r["node"]: r for r in high.collect()}
            parts = low.collect()
            assert sum(r["n"] for r in parts) == sum(r["n"] for r in balls.values())
            for r in parts:
                up = balls[r["up"]]
                away = np.linalg.norm(np.frombuffer(r["centre"]) - np.frombuffer(up["centre"]))
                assert away + r["radius"] <= up["radius"] * (1 + 1e-12) + 1e-9
        return levels

    monkeypatch.setattr(topk, "materialise", noted)
    monkeypatch.setattr(topk, "_levels", checked)
    rng = random.Random(5)
    turn = lambda k: 2 * math.pi * (k % 10) / 10
    rows = [(k, [100 * math.cos(turn(k)) + rng.gauss(0, 0.1), 100 * math.sin(turn(k)) + rng.gauss(0, 0.1)]) for k in range(400)]
    df = made(spark, rows)
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = topk.top_k(df, F.col("id") % 20 < 10, k=5).collect()
    want = [r for q in range(10) for r in brute([((i - q) % 400, v) for i, v in exact], 5, 64, 20)]
    assert len(found) == 200 * 5
    blocks = written["candidate-trees"].count() * written["query-trees"].count()
    assert written["block-pairs"].count() < blocks / 3
    scores = sorted((r["rank"], r["score"]) for r in found)
    assert scores == sorted((r, s) for _, r, _, s in want)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [0.5, 2.0]), (5, None), (6, []), (7, [1.0, None]), (8, [nan, 1.0]), (40, [inf, 1.0]), (None, [1.0, 1.0]), (9, [0.0, 0.0]), (10, [-1.0, 0.01]), (10, [-1.0, 0.01]), (60, [1.0, 2.0, 3.0]), (11, [1.0, 0.0, 0.0])]
    found = topk.top_k(made(spark, rows), F.col("id") % 20 == 0, k=3)
    assert sorted(map(tuple, found.collect())) == brute(rows, 3, 64, 20)
    assert topk.top_k(made(spark, rows[:1]), F.col("id") % 20 == 0).count() == 0
    assert topk.top_k(made(spark, []), F.col("id") % 20 == 0).count() == 0


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(k, [float(rng.randint(-(2**24), 2**24)) for _ in range(3)]) for k in range(80)]
    found = topk.top_k(made(spark, rows), F.col("id") % 20 == 0, k=5)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 64, 20)


def test_radii_cover_and_centres_are_apart():
    import numpy as np

    rng = np.random.default_rng(0)
    rows = np.concatenate([rng.integers(-60, 60, (500, 8)), np.zeros((90, 8), np.int64)])
    tree = topk.CoverTree(np.arange(len(rows)), rows)
    order, nodes = tree.packed()
    assert sorted(order.tolist()) == list(range(len(rows)))
    placed = rows[order]
    for (a, b, c, parent), radius in zip(nodes.tolist(), tree.radii):
        assert a <= c < b
        assert np.sqrt(((placed[a:b] - placed[c]) ** 2).sum(axis=1)).max() <= radius + 1e-9
        if parent >= 0:
            assert nodes[parent][0] <= a and b <= nodes[parent][1]
