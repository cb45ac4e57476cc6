"""SimHash near-duplicates through a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from feedweave.llm.common import bounded_batches, connected_components, materialise

BYTES = 8
SEED = 42
POSTING_ROWS = 1024  # members of a posting list whose shared entries are tallied pair by pair


def fingerprint(text: bytes, shingle_words: int) -> int:
    """The 64-bit SimHash of one text as an unsigned number; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    take = min(shingle_words, len(words))
    digest = xxhash.xxh64_digest
    spans = zip(starts[: len(words) - take + 1].tolist(), ends[take - 1 :].tolist())
    hashes = np.frombuffer(b"".join([digest(line[a:b], SEED) for a, b in spans]), np.uint8)
    bits = np.unpackbits(hashes.reshape(-1, BYTES), axis=1)
    over_half = 2 * np.add.reduce(bits, axis=0, dtype=np.int64) > len(bits)
    return int.from_bytes(np.packbits(over_half).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint", shingle_words: int = 3) -> DataFrame:
    """Add the SimHash of the whole text as a (signed) long.

    A-Z are lower-cased, words are maximal runs of anything but ASCII white
    space, shingles are ``shingle_words`` words joined by one blank, repeats
    included; a shorter text is one shingle. A null or wordless text has 0. An
    existing column called ``out`` is replaced.
    """
    bounded_batches(docs.sparkSession)

    @pandas_udf("long")
    def simhash(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            values = [fingerprint(t.encode() if t else b"", shingle_words) for t in batch]
            yield pd.Series(np.array(values, np.uint64).view(np.int64))

    return docs.withColumn(out, simhash(F.col(text)))


def _masks(distance: int) -> list[tuple[int, tuple[int, ...]]]:
    """(mask as signed long, positions left out) for every choice of bytes that must agree."""
    found = []
    for free in combinations(range(BYTES), distance):
        mask = sum(0xFF << (8 * p) for p in range(BYTES) if p not in free)
        found.append((mask - (1 << 64) if mask >= 1 << 63 else mask, free))
    return found


def _near(bits: int, distance: int) -> np.ndarray:
    """All numbers of ``bits`` bits with one to ``distance`` bits set."""
    return np.array([sum(1 << b for b in c) for k in range(1, distance + 1) for c in combinations(range(bits), k)], np.int64)


def _linked(members: np.ndarray, free: tuple[int, ...], near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect all linked members of one posting list.

    All members agree in the other bytes, so their rest over the free bytes is a
    small number; partners are looked up by flipping bits instead of pair by
    pair. Every link found joins two trees at most once.
    """
    rest = np.zeros(len(members), np.int64)
    for k, p in enumerate(free):
        rest |= ((members >> np.int64(8 * p)) & 0xFF) << (8 * k)
    order = np.argsort(rest)
    rest, members = rest[order], members[order]
    parent = list(range(len(rest)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for flip in near:
        other = rest ^ flip
        at = np.minimum(np.searchsorted(rest, other), len(rest) - 1)
        for i in np.flatnonzero((rest[at] == other) & (other > rest)).tolist():
            a, b = root(i), root(int(at[i]))
            if a != b:
                parent[b] = a
                yield int(members[i]), int(members[at[i]])


def _choices(distance: int) -> list[tuple[int, tuple[int, ...]]]:
    """(mask as signed long, positions left out) for every two of ``distance + 2`` runs of bytes.

    So many differing bits spoil at most ``distance`` of the runs, so linked
    fingerprints agree in two at least.
    """
    runs = [tuple(run.tolist()) for run in np.array_split(np.arange(BYTES), distance + 2)]
    found = []
    for pair in combinations(runs, 2):
        agreed = pair[0] + pair[1]
        mask = sum(0xFF << (8 * p) for p in agreed)
        found.append((mask - (1 << 64) if mask >= 1 << 63 else mask, tuple(p for p in range(BYTES) if p not in agreed)))
    return found


def _tally(members: np.ndarray, free: tuple[int, ...]) -> np.ndarray:
    """How many (position, byte) entries each two members share.

    Every member has the entries outside ``free`` in common with all others; the
    rest is counted through an inverted index from byte to members, position by
    position.
    """
    shared = np.full((len(members), len(members)), BYTES - len(free), np.uint8)
    for p in free:
        byte = (members >> np.int64(8 * p)) & 0xFF
        order = np.argsort(byte, kind="stable")
        ends = np.flatnonzero(np.diff(byte[order])) + 1
        for posting in np.split(order, ends):
            if len(posting) > 1:
                shared[np.ix_(posting, posting)] += 1
    return shared


def _counted(members: np.ndarray, free: tuple[int, ...], distance: int) -> Iterator[tuple[int, int]]:
    """Edges that connect all linked members: enough shared entries first, then the bits."""
    shared = _tally(members, free)
    np.fill_diagonal(shared, 0)
    a, b = np.nonzero(shared >= BYTES - distance)
    near = np.zeros(shared.shape, bool)
    near[a, b] = np.bitwise_count((members[a] ^ members[b]).view(np.uint64)) <= distance
    waiting = near.any(axis=1)
    while waiting.any():
        reached = [int(waiting.argmax())]
        waiting[reached[0]] = False
        for i in reached:
            fresh = np.flatnonzero(near[i] & waiting).tolist()
            waiting[fresh] = False
            reached += fresh
            for j in fresh:
                yield int(members[i]), int(members[j])


def _edges(postings: DataFrame, linked: Callable[[int, np.ndarray], Iterable[tuple[int, int]]]) -> DataFrame:
    """The edges that ``linked`` finds in every posting list ``k``, ``members``."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            for k, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                pairs += linked(k, members.values.to_numpy())
            both = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["src", "dst"])

    return postings.mapInArrow(verify, "src long, dst long")


def _entries(prints: DataFrame, masks: list[tuple[int, tuple[int, ...]]]) -> DataFrame:
    """One row ``f``, ``k``, ``shared`` for every fingerprint and mask, over as many tasks as shuffles have.

    The table of fingerprints is small beside its entries, so it is dealt before it is multiplied.
    """
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = F.array(*[F.struct(F.lit(k).alias("k"), F.col("f").bitwiseAND(F.lit(m)).alias("shared")) for k, (m, _) in enumerate(masks)])
    return prints.select("f").repartition(parts, "f").distinct().select("f", F.explode(keys).alias("e")).select("f", "e.k", "e.shared")


def links(prints: DataFrame, fingerprint: str = "fingerprint", distance: int = 2, posting_rows: int = POSTING_ROWS) -> DataFrame:
    """Edges ``src``, ``dst`` that connect all fingerprints within ``distance`` bits.

    A fingerprint is eight (position, byte) entries. Differing in ``distance``
    bits spoils at most so many, so linked fingerprints share at least
    ``8 - distance`` of them: the guaranteed minimum. They also agree in two of
    ``distance + 2`` runs of bytes, which key the index (six keys for two bits).
    In a posting list the shared entries of each two members are tallied; pairs
    that reach the minimum are verified by their bits, and only a spanning set
    of the links leaves the list.

    A tally is quadratic, so it is made in lists of ``posting_rows`` members at
    most. Fingerprints of longer lists are keyed again by every choice of
    ``8 - distance`` bytes: meeting there is the full count, a key is shared by
    at most ``2 ** (8 * distance)`` distinct fingerprints, and partners are found by
    flipping bits. Linked fingerprints that meet in long lists only are both in
    that set, so nothing is lost. Nulls take no part, repeats count once.
    """
    if not 0 <= distance <= 3:
        raise ValueError("distance must be 0 to 3 bits")
    spark = prints.sparkSession
    bounded_batches(spark)
    known = prints.select(F.col(fingerprint).alias("f")).where("f is not null")
    if distance == 0:
        return known.where("false").select(F.col("f").alias("src"), F.col("f").alias("dst"))
    choices, masks = _choices(distance), _masks(distance)
    entries = _entries(known, choices)
    sizes = materialise(entries.groupBy("k", "shared").agg(F.count("*").alias("n")).where("n > 1"), "posting-sizes")
    met = materialise(entries.join(sizes, ["k", "shared"]), "postings")
    short = met.where(F.col("n") <= posting_rows).groupBy("k", "shared").agg(F.collect_list("f").alias("members"))
    tallied = _edges(short.select("k", "members"), lambda k, members: _counted(members, choices[k][1], distance))
    again = _entries(met.where(F.col("n") > posting_rows), masks).groupBy("k", "shared").agg(F.collect_list("f").alias("members"))
    near = _near(8 * distance, distance)
    flipped = _edges(again.where(F.size("members") > 1).select("k", "members"), lambda k, members: _linked(members, masks[k][1], near))
    return tallied.union(flipped)


def _grouped(docs: DataFrame, id_col: str, text: str, shingle_words: int, distance: int) -> DataFrame:
    """One row per document: ``id``, fingerprint ``f``, ``component`` (a fingerprint of the group), ``component_id``."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    prints = materialise(with_fingerprint(slim, "t", "f", shingle_words).select("id", "f"), "prints")
    nodes = materialise(prints.groupBy("f").agg(F.min("id").alias("first")), "nodes")
    groups = materialise(connected_components(links(nodes, "f", distance), "src", "dst"), "groups")
    member = nodes.join(groups, nodes["f"] == groups["node"]).select("f", "first", "component")
    smallest = member.groupBy("component").agg(F.min("first").alias("least"))
    grouped = member.join(smallest, "component").select(F.col("f").alias("g"), "component", "least")
    named = nodes.join(grouped, F.col("f") == F.col("g"), "left").select(
        F.col("f").alias("n"), F.coalesce("component", "f").alias("component"), F.coalesce("least", "first").alias("component_id")
    )
    return prints.join(named, F.col("f") == F.col("n")).select("id", "f", "component", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = 3, distance: int = 2
) -> DataFrame:
    """One row per document with its fingerprint and its group.

    Documents link when their fingerprints differ in ``distance`` bits or fewer;
    ``component_id`` is the smallest id reachable over links, the own included.
    Wordless and null texts have fingerprint 0 and link like any other. Repeated
    rows stay repeated; a row with a null id has its fingerprint, and the group
    of the others with linked fingerprints if there are any, else null. All
    other columns are dropped, so none can clash. Equal fingerprints are one node
    of the graph, so copies never become pairs. Returns the id, ``fingerprint``
    (16 lower-case hex digits) and ``component_id``.
    """
    return _grouped(docs, id_col, text, shingle_words, distance).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("f")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def _first_rows(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row for each key: the first by a digest of all columns, so that only fully equal rows tie."""
    order = Window.partitionBy(*keys).orderBy(F.sha2(F.to_json(F.struct(*columns)), 256))
    return rows.withColumn("__first", F.row_number().over(order)).where("__first = 1").select(*columns)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle_words: int = 3, distance: int = 2) -> DataFrame:
    """Keep one row of each near-duplicate group: the one with the smallest id.

    Columns stay as they are. A row with a null id is kept only if its whole
    group has no id. Where one id stands on several rows, each group keeps its own: of the
    smallest id's rows in the group those with the smallest fingerprint, and of these the first
    by a digest of all columns.
    """
    found = materialise(_grouped(docs, id_col, text, shingle_words, distance), "found")
    first = found.where("id = component_id").groupBy("component").agg(F.min("id").alias("__keep"), F.min("f").alias("__print"))
    kept = first.select("__keep", "__print")
    repeated = found.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    ids = kept.select("__keep").distinct()
    if repeated.isEmpty():
        with_id = docs.join(ids, docs[id_col] == F.col("__keep"), "left_semi")
    else:
        near = docs.join(ids, docs[id_col] == F.col("__keep"), "left_semi")
        near = with_fingerprint(near, text, "__f", shingle_words)
        near = near.join(kept, (F.col(id_col) == F.col("__keep")) & (F.col("__f") == F.col("__print")), "left_semi")
        with_id = _first_rows(near, [id_col, "__f"], docs.columns)
    lone = docs.where(F.col(id_col).isNull())
    if lone.isEmpty():
        return with_id
    lone = with_fingerprint(lone, text, "__f", shingle_words)
    label = found.where("component_id is null").select(F.col("f").alias("__n"), F.col("component").alias("__c")).distinct()
    lone = _first_rows(lone.join(label, F.col("__f") == F.col("__n")), ["__c"], docs.columns)
    return with_id.unionByName(lone)
