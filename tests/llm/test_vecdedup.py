import math
import random

import pytest

from feedweave.llm import vecdedup

SCHEMA = "vec_id long, embedding array<double>, n_links string, kept int"


def brute(rows, threshold):
    usable = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    label, links = {k: k for k in usable}, dict.fromkeys(usable, 0)

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for n, a in enumerate(usable):
        for b in usable[:n]:
            v, w = rows[a][1], rows[b][1]
            if len(v) != len(w):
                continue
            cosine = math.fsum(x * y for x, y in zip(v, w)) / math.sqrt(math.fsum(x * x for x in v) * math.fsum(y * y for y in w))
            if v == w or cosine >= threshold:
                links[a] += 1
                links[b] += 1
                label[root(a)] = root(b)
    least = {}
    for k in usable:
        least[root(k)] = min(rows[k][0], least.get(root(k), rows[k][0]))
    found = []
    for k, (i, _) in enumerate(rows):
        c = least[root(k)] if k in label else i
        found.append((i, links.get(k, 0), c, i is not None and i == c))
    return sorted(found, key=str)


def made(spark, rows):
    return spark.createDataFrame([(i, v, "old", 1) for i, v in rows], SCHEMA)


@pytest.mark.parametrize("dim, blocks", [(3, 40), (16, 64), (64, 1 << 21)])
def test_equals_brute_force(spark, monkeypatch, dim, blocks):
    monkeypatch.setattr(vecdedup, "BLOCK_BYTES", blocks if blocks > 99 else blocks * 8 * dim)
    monkeypatch.setattr(vecdedup, "LEAF", 16)
    rng = random.Random(dim)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(30)]
    rows = []
    for k in range(300):
        centre = rng.choice(centres)
        rows.append((k * 37 % 1013, [x + rng.gauss(0, 0.25) for x in centre]))
    rows += [(2000 + k, [3 * x for x in rows[5][1]]) for k in range(9)] + [(3000 + k, rows[6][1]) for k in range(9)]
    found = vecdedup.near_duplicates(made(spark, rows))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, 0.95)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(5, None), (6, []), (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [0.0, 0.0]), (None, [1.0, 1.0])]
    rows += [(3, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.01]), (1, [1.0, 1.0, 0.0]), (4, [-1.0, -1.0]), (11, [1e300, 1e300]), (12, [1e-300, 1e-300])]
    found = sorted(map(tuple, vecdedup.near_duplicates(made(spark, rows)).collect()), key=str)
    expected = brute([r for r in rows if r[0] not in (11, 12)], 0.95)
    linked = {r[0] for r in found if r[2] == 2}
    assert linked == {2, 3, 11, 12}
    assert len(found) == len(rows)
    assert [r for r in found if r[0] not in (2, 3, 11, 12)] == [r for r in expected if r[0] not in (2, 3)]
    assert vecdedup.near_duplicates(made(spark, [])).count() == 0


def test_dense_group_is_counted_not_listed(spark):
    """A group in which all are linked: its links are counted, and a spanning set leaves the join."""
    rng = random.Random(4)
    rows = [(k, [1.0 + rng.random() / 100 for _ in range(8)]) for k in range(1200)]
    nodes = spark.createDataFrame([(i, v, 1) for i, v in rows], "node long, v array<double>, m long")
    links = vecdedup._links(nodes, 0.95)
    assert links.count() < 4 * len(rows)
    found = vecdedup.near_duplicates(made(spark, rows))
    assert {(r["n_links"], r["component_id"]) for r in found.collect()} == {(1199, 0)}


def test_bounds_are_no_more_than_the_distance():
    """Leading coordinates and the norm of the rest: never further apart than the vectors, and closer to it with the rest."""
    import numpy as np

    rng = np.random.default_rng(3)
    for dim in (3, 8, 40):
        u = vecdedup._unit(rng.normal(size=200 * dim), dim)
        u[100:] = vecdedup._unit((u[:100] + rng.normal(size=(100, dim)) * 1e-6).ravel(), dim)
        for axes in ({}, {dim: np.linalg.qr(rng.normal(size=(dim, min(dim, vecdedup.LEADING))))[0]}):
            p = vecdedup._project(u, axes)
            apart = np.sqrt(((u[:, None] - u[None]) ** 2).sum(-1))
            near = np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1))
            lead = np.sqrt(((p[:, None, :-1] - p[None, :, :-1]) ** 2).sum(-1))
            assert (near <= apart + 1e-12).all() and (near >= lead).all()


def test_numbers_follow_the_sequence(spark, monkeypatch):
    """Gapless over partitions and chunks of them, empty partitions included."""
    monkeypatch.setattr(vecdedup, "CHUNK", 4)
    sizes = {part: part * 7 % 5 for part in range(23)}
    blocks = [(part << 32 | k,) for part, n in sizes.items() for k in range(n)]
    found = vecdedup._numbered(spark.createDataFrame(blocks, "block long").repartition(5)).orderBy("block").collect()
    assert [(r["block"], r["i"]) for r in found] == [(b, i) for i, (b,) in enumerate(blocks)]
