import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedweave.llm import simhash

SCHEMA = "doc_id long, text string, fingerprint string, f long"


def brute_print(text, shingle):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, distance):
    """Smallest id reachable over links, for (id, print) rows."""
    label = {k: k for k in range(len(prints))}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= distance:
                label[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(prints):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, f"{p:016x}", least.get(root(k))) for k, (i, p) in enumerate(prints)]


def some_texts(n=120):
    rng = random.Random(3)
    words = ["alpha", "Beta", "gamma", "DELTA", "épée", "zeta", "eta", "theta", "Ünder", "iota"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(n)]
    for t in list(texts[:40]):
        parts = t.split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        texts += [t, " ".join(parts), t + "\n\tTAIL"]
    return texts


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_groups_equal_brute_force(spark, distance):
    texts = some_texts()
    docs = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
    found = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), distance=distance)
    expected = brute_groups([(i, brute_print(t, 3)) for i, t in docs], distance)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


@pytest.mark.parametrize("shingle", [1, 3, 5])
def test_fingerprint(shingle):
    for t in [*some_texts(20), "", " \t\n", "one", "one two", "x" * 300_000, "a b c d e", "ÀB ÉC"]:
        assert simhash.fingerprint(t.encode(), shingle) == brute_print(t, shingle), t[:50]


@pytest.mark.parametrize("posting_rows", [1, 40, 1024, 1 << 20])
def test_links_of_dense_prints_lose_nothing(spark, posting_rows):
    """Very many prints that differ in one or two bits, over bytes and within one, form one group."""
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(64) if a != b} | {rng.getrandbits(64) for _ in range(300)}
    signed = [(p - (1 << 64) if p >= 1 << 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fingerprint long"), posting_rows=posting_rows).collect()
    assert all(bin((r["src"] ^ r["dst"]) & (1 << 64) - 1).count("1") <= 2 for r in edges)
    from feedweave.llm.common import connected_components

    made = spark.createDataFrame(edges, "src long, dst long")
    groups = {r["node"]: r["component"] for r in connected_components(made, "src", "dst").collect()}
    want = brute_groups([(k, p) for k, p in enumerate(prints)], 2)
    sizes = sorted(sum(1 for w in want if w[2] == c) for c in {w[2] for w in want})
    got = list(groups.values())
    assert sorted(got.count(c) for c in set(got)) == [s for s in sizes if s > 1]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_tally_decides_before_bits(distance):
    """The tally equals a count by hand; members that share too few entries are never linked, near ones always."""
    rng = random.Random(distance)
    for _, free in simhash._choices(distance):
        base = rng.getrandbits(64)
        prints = {base}
        for _ in range(150):
            flips = sum(1 << b for b in {8 * rng.choice(free) + rng.randrange(8) for _ in range(rng.randint(1, 4))})
            prints.add(rng.choice(sorted(prints)) ^ flips)
        members = np.array(sorted(prints), np.uint64).view(np.int64)
        shared = simhash._tally(members, free)
        split = [p.to_bytes(8, "big") for p in sorted(prints)]
        by_hand = np.array([[sum(x == y for x, y in zip(a, b)) for b in split] for a in split])
        assert (shared == by_hand)[~np.eye(len(split), dtype=bool)].all()
        edges = list(simhash._counted(members, free, distance))
        assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= distance for a, b in edges)
        groups = brute_groups(list(enumerate(sorted(prints))), distance)
        assert len(edges) == len(prints) - len({g for _, _, g in groups})


def test_every_link_agrees_in_two_runs():
    for distance in (1, 2, 3):
        masks = [m & (1 << 64) - 1 for m, _ in simhash._choices(distance)]
        rng = random.Random(distance)
        for _ in range(3000):
            flips = sum(1 << b for b in rng.sample(range(64), distance))
            assert any(flips & m == 0 for m in masks)


def test_odd_rows(spark):
    rows = [(1, None, "x", 5), (2, "", "x", 5), (None, "some words here", "y", 6), (4, "some words here", "y", 6), (4, "some words here", "y", 6), (9, "other text altogether", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert found == sorted([(1, 1), (2, 1), (None, 4), (4, 4), (4, 4), (9, 9)], key=str)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 9]
    alone = spark.createDataFrame([(None, "a b c d", "", 1), (None, "a b c d", "", 1), (None, "q w e r", "", 2)], SCHEMA)
    assert simhash.keep_first(alone).count() == 2
    assert simhash.near_duplicates(alone).where(F.col("component_id").isNotNull()).count() == 0
    assert simhash.near_duplicates(df.where("false")).count() == 0
    assert simhash.keep_first(df.where("false")).count() == 0


def test_no_pairs_of_copies(spark):
    """A third of the rows are copies: they are one node of the index."""
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'the very same words again', concat('own words number ', id, ' ', id * 7, ' ', id * 13)) AS text")
    found = simhash.near_duplicates(docs)
    assert found.where("component_id = 0").count() >= 1000
    assert found.count() == 3000


def test_one_id_in_several_groups(spark):
    """Each group keeps a row, also where groups share their smallest id; the choice does not depend on the order of rows."""
    rows = [(1, "all of the first text", "a", 1), (1, "quite another thing here", "b", 2), (2, "all of the first text", "c", 3), (3, "quite another thing here", "d", 4)]
    rows += [(1, "all of the first text", "z", 9), (7, "third text of its own", "e", 5), (None, "a fourth text alone", "f", 6), (None, "a fourth text alone", "g", 7)]
    found = {tuple(sorted(map(tuple, simhash.keep_first(spark.createDataFrame(some, SCHEMA)).collect()), key=str)) for some in (rows, rows[::-1], rows[4:] + rows[:4])}
    assert len(found) == 1
    (kept,) = found
    assert sorted((r[0], r[1]) for r in kept if r[0]) == [(1, "all of the first text"), (1, "quite another thing here"), (7, "third text of its own")]
    assert [r[1] for r in kept if r[0] is None] == ["a fourth text alone"]
