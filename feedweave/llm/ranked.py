"""Ranked lexical search: dense tiles of item weights times document impacts, multiplied by BLAS."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedweave.llm.common import bounded_batches, materialise

# A term is a run of ASCII letters and digits and of all other characters beyond ASCII; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

# Bytes of item texts whose vocabulary is handed to the tasks at once.
GROUP_BYTES = 4 << 20
# Documents, items and terms of a tile: no matrix is larger than 32 MB.
TILE_DOCS, TILE_ITEMS, TILE_TERMS = 2048, 256, 2048
# Of a group of so many items a task keeps the matrices between document tiles; of more it makes them anew.
KEPT_ITEMS = 1024
# An impact is below 10^6, so partial sums of weights up to this stay below 2^53.
LARGEST_IMPACT = 10**6
WEIGHT_BOUND = 2**53 // LARGEST_IMPACT - 1


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in UTF-8, lower-cased; none for null."""
    return _TERM_BYTES.findall(text.encode().lower()) if text else []


@dataclass
class Group:
    """Items whose vocabulary travels together: sparse rows of (term, repeats)."""

    item_ids: list[int | None]
    starts: np.ndarray
    terms: np.ndarray
    repeats: np.ndarray
    vocabulary: list[bytes]


def _group(items: DataFrame) -> Group:
    """Read the items of one group; rows that share an id are one item."""
    counted: dict[int | None, Counter] = {}
    for row in items.toLocalIterator():
        counted.setdefault(row["item_id"], Counter()).update(terms_of(row["text"]))
    ids = sorted((i for i, c in counted.items() if c), key=lambda i: (i is not None, i))
    number: dict[bytes, int] = {}
    starts, terms, repeats = [0], [], []
    for i in ids:
        terms += [number.setdefault(t, len(number)) for t in counted[i]]
        repeats += counted[i].values()
        starts.append(len(terms))
    return Group(ids, np.array(starts), np.array(terms, np.int64), np.array(repeats, np.int64), list(number))


def forward_index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Terms of the vocabulary in every document that holds any term.

    Returns doc_id, ``n`` (all terms with repeats), and ``ids`` and ``counts`` of the listed terms.
    """
    bounded_batches(docs.sparkSession)
    kinds = pa.list_(pa.int32())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: k for k, term in enumerate(vocabulary)}.get
        for batch in batches:
            rows, sizes, ids, counts = [], [], [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                found = terms_of(text)
                if not found:
                    continue
                tally = Counter(map(number, found))
                tally.pop(None, None)
                rows.append(at)
                sizes.append(len(found))
                ids.append(list(tally.keys()))
                counts.append(list(tally.values()))
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64())]
            columns += [pa.array(ids, kinds), pa.array(counts, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "ids", "counts"])

    return docs.mapInArrow(count, "doc_id long, n long, ids array<int>, counts array<int>")


def impacts(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """The impact of a term that occurs ``tf`` times in a document of ``n`` terms."""
    if len(n) and 75 * int(n.max()) * docs >= 2**63:
        share = np.array([75 * int(x) * docs // length for x in n], np.int64)
    else:
        share = 75 * n * docs // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * (25 + share))


@dataclass
class Block:
    """Some items of a group as dense weights, cut into tiles of terms with bounded sums."""

    first: int
    items: int
    tiles: list[tuple[np.ndarray, np.ndarray]]


def blocks(group: Group, weights: np.ndarray) -> Iterator[Block]:
    """Item blocks with their vocabulary tiles, made one at a time.

    Within a tile the weights of an item sum to ``WEIGHT_BOUND`` at most, so a product of the tile
    with impacts is an exact integer in double precision. A term that outweighs this by itself
    is spread over several tiles.
    """
    for first in range(0, len(group.item_ids), TILE_ITEMS):
        last = min(first + TILE_ITEMS, len(group.item_ids))
        cut = slice(group.starts[first], group.starts[last])
        item = np.repeat(np.arange(last - first), np.diff(group.starts[first : last + 1]))
        term, weight = group.terms[cut], weights[group.terms[cut]] * group.repeats[cut]
        used = weight > 0
        item, term, weight = item[used], term[used], weight[used]
        tiles = []
        while len(term):
            part = np.minimum(weight, WEIGHT_BOUND)
            order = np.argsort(term, kind="stable")
            names, at = np.unique(term[order], return_inverse=True)
            # sums of an item's weights over its terms in ascending order decide where tiles end
            tile_of, sums, width, tile = np.empty(len(names), np.int64), np.zeros(last - first, np.int64), 0, 0
            bounds = np.searchsorted(at, np.arange(len(names) + 1))
            for k in range(len(names)):
                rows = order[bounds[k] : bounds[k + 1]]
                if width == TILE_TERMS or (sums[item[rows]] + part[rows] > WEIGHT_BOUND).any():
                    tile, width = tile + 1, 0
                    sums[:] = 0
                sums[item[rows]] += part[rows]
                tile_of[k], width = tile, width + 1
            column = np.searchsorted(names, term)
            for t in range(tile + 1):
                mine = np.flatnonzero(tile_of == t)
                dense = np.zeros((last - first, len(mine)))
                rows = np.flatnonzero(tile_of[column] == t)
                dense[item[rows], column[rows] - mine[0]] = part[rows]
                tiles.append((names[mine], dense))
            rest = weight > part
            item, term, weight = item[rest], term[rest], (weight - part)[rest]
        yield Block(first, last - first, tiles)


def _best(item: np.ndarray, score: np.ndarray, known: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows of each item: highest score, then smallest id, null ids first."""
    order = np.lexsort((doc, known, -score, item))
    sorted_items = item[order]
    starts = np.searchsorted(sorted_items, sorted_items, side="left")
    return order[np.arange(len(order)) - starts < k]


def rank(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents with score above 0 for every item: item_id, rank, doc_id, score.

    ``docs`` holds doc_id and text, ``items`` item_id and text; other columns are ignored. With N the documents
    that hold any term, L their terms, n and tf a document's terms and one term's occurrences in it, df the
    documents that hold a term: a term weighs floor(1000 ln((2N+2)/(2df+1))), m is 25 + 75 n N div L, and
    the score sums weight * (10^9 tf div (1000 tf + 8 m)) over the item's terms with repeats.

    Null and empty texts have no terms: such items return nothing and such documents count nowhere. A document is a
    row; rows that repeat an id are ranked each for itself. Item rows that share an id (null is one) are one item
    with the terms of all. Equal scores go by ascending doc_id, null first. Empty tables give no rows.

    The items are a query set: groups of at most ``GROUP_BYTES`` of text (or one longer item) meet all documents
    one after the other. For each group the documents are read once into a table of their counts of the group's
    terms; tasks then multiply item blocks by document tiles over the terms that both hold. Partial
    sums are bounded below 2^53, so double precision is exact; they are added up in 64-bit integers. Each task
    keeps k rows an item, with ties settled.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    spark = docs.sparkSession
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    place = F.pmod(F.xxhash64("item_id"), F.lit(groups))
    found = None
    for g in range(groups):
        part = _search(docs, _group(items.where(place == g)), k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _search(docs: DataFrame, group: Group, k: int) -> DataFrame | None:
    """Of each task, the k best documents of each item of one group; None if no document or item holds a term."""
    if not group.item_ids:
        return None
    index = materialise(forward_index(docs, group.vocabulary), "forward_index")
    totals = index.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    n_docs, length = totals["docs"], totals["length"]
    if not n_docs:
        return None
    frequency = np.zeros(len(group.vocabulary))
    # one row for each term of the group
    for row in index.select(F.explode("ids").alias("id")).groupBy("id").count().toLocalIterator():
        frequency[row["id"]] = row["count"]
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * frequency + 1))).astype(np.int64)
    weights[frequency == 0] = 0  # in no document: adds to no score

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[np.ndarray]] = {}
        column_of = np.full(len(group.vocabulary), -1, np.int64)

        def tile(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held)
            ids, counts = table.column("ids").combine_chunks(), table.column("counts").combine_chunks()
            doc = table.column("doc_id").combine_chunks()
            known, doc = ~np.array(doc.is_null()), doc.fill_null(0).to_numpy()
            row = np.repeat(np.arange(len(doc)), ids.value_lengths().to_numpy())
            term, tf = ids.flatten().to_numpy(), counts.flatten().to_numpy().astype(np.int64)
            impact = impacts(tf, table.column("n").to_numpy()[row], n_docs, length)
            for block in kept if kept is not None else blocks(group, weights):
                score = np.zeros((block.items, len(doc)), np.int64)
                for names, dense in block.tiles:
                    column_of[names] = np.arange(len(names))
                    column = column_of[term]
                    column_of[names] = -1
                    hit = np.flatnonzero(column >= 0)
                    shared, at = np.unique(column[hit], return_inverse=True)
                    held_terms = np.zeros((len(shared), len(doc)))
                    held_terms[at, row[hit]] = impact[hit]
                    score += (dense[:, shared] @ held_terms).astype(np.int64)
                least = np.ones(block.items, np.int64)
                if len(doc) > k:
                    least = np.maximum(least, np.partition(score, len(doc) - k, axis=1)[:, len(doc) - k])
                item, at = np.nonzero(score >= least[:, None])
                rows = [item + block.first, score[item, at], known[at], doc[at]]
                if block.first in best:
                    rows = [np.concatenate(x) for x in zip(best[block.first], rows)]
                keep = _best(*rows, k)
                best[block.first] = [x[keep] for x in rows]

        kept = list(blocks(group, weights)) if len(group.item_ids) <= KEPT_ITEMS else None
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                if size + part.num_rows > TILE_DOCS:
                    tile(held)
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if held:
            tile(held)
        names = np.array([-1 if i is None else i for i in group.item_ids], np.int64)
        nameless = np.array([i is None for i in group.item_ids])
        for item, score, known, doc in best.values():
            columns = [pa.array(names[item], mask=nameless[item]), pa.array(doc, mask=~known), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score"])

    scored = index.where(F.size("ids") > 0).mapInArrow(multiply, "item_id long, doc_id long, score long")
    return scored
