import math
import random
from collections import Counter

import numpy as np
import pytest
import regex

from feedweave.llm import ranked

TERM = regex.compile(ranked.TERM)


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k):
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, Counter()).update(terms(text))
    out = []
    for i, wanted in asked.items():
        scored = []
        for d, counts, n in held:
            m = 25 + 75 * n * n_docs // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t, times in wanted.items()
                if t in counts
            )
            if score > 0:
                scored.append((-score, d is not None, d or 0, d))
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def made(seed, n):
    r = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "ünï", "Été", "x1", "42", "日本", "ß", "-", "!", "\x00"]
    text = lambda: r.choice([" ", ", ", "\n"]).join(r.choices(words, weights=range(1, len(words) + 1), k=r.randrange(0, 30)))
    return [(k, None if r.random() < 0.03 else text()) for k in range(n)]


@pytest.fixture
def frames(spark):
    def make(docs, items):
        d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7 AS n", "'z' AS item_id", "'q' AS score")
        return d, spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS rank", "2 AS doc_id")

    return make


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_equals_brute_force(frames, rows_of, k):
    docs, items = made(1, 400) + [(1000, "word " * 4000), (1001, "")], made(2, 40)
    found = ranked.rank(*frames(docs, items), k)
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == brute_force(docs, items, k)


def test_ties_go_by_id(frames, rows_of):
    docs = [(k, "same words here") for k in range(3000, 0, -1)] + [(k, "other things") for k in range(4000, 9000)]
    found = ranked.rank(*frames(docs, [(1, "same WORDS"), (2, "none of it")]), 5)
    assert [r[2] for r in rows_of(found, "item_id", "rank", "doc_id", "score")] == [1, 2, 3, 4, 5]


def test_nulls_and_shared_ids(frames, rows_of):
    docs = [(None, "a b"), (1, "a b"), (1, "a b"), (2, None), (3, ""), (4, "c")]
    items = [(None, "a"), (7, "a"), (7, "b a"), (8, None), (9, "!?"), (10, "zzz")]
    found = ranked.rank(*frames(docs, items), 10)
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == brute_force(docs, items, 10)


def test_groups_of_items_give_the_same(frames, rows_of, monkeypatch):
    docs, items = made(3, 200), made(4, 30)
    monkeypatch.setattr(ranked, "GROUP_BYTES", 200)
    monkeypatch.setattr(ranked, "TILE_DOCS", 16)
    found = ranked.rank(*frames(docs, items), 4)
    assert rows_of(found, "item_id", "rank", "doc_id", "score") == brute_force(docs, items, 4)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([], [])])
def test_empty(frames, docs, items):
    assert ranked.rank(*frames(docs, items), 10).collect() == []


def test_partial_sums_stay_exact(monkeypatch):
    """Weights whose sum passes 2^53 are spread over tiles, and their total is kept."""
    repeats = np.array([3_000_000, 1, 700_000, 2, 400_000])
    group = ranked.Group([1, 2], np.array([0, 3, 5]), np.array([0, 1, 2, 1, 2]), repeats, [b"a", b"b", b"c"])
    weights = np.array([28_000, 5, 27_000])
    (block,) = ranked.blocks(group, weights)
    total = np.zeros((2, 3), np.int64)
    for names, dense in block.tiles:
        assert (dense.sum(axis=1) * ranked.LARGEST_IMPACT < 2**53).all()
        total[:, names] += dense.astype(np.int64)
    assert total.tolist() == [[3_000_000 * 28_000, 5, 700_000 * 27_000], [0, 10, 400_000 * 27_000]]


def test_impacts_beyond_64_bits_of_the_product():
    tf, n = np.array([3, 1]), np.array([10**7, 5])
    docs, length = 10**12, 5 * 10**14
    assert ranked.impacts(tf, n, docs, length).tolist() == [10**9 * t // (1000 * t + 8 * (25 + 75 * m * docs // length)) for t, m in ((3, 10**7), (1, 5))]
