"""Embedding near-duplicates: epsilon grid order join of unit vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweave.llm.common import connected_components, materialise, small_batches

LEADING = 8  # principal dimensions that are gridded
BOUNDS = LEADING + 1  # and the norm of what they leave
PCA_ROWS = 2048  # vectors the directions are fitted on; they decide speed, not results
BLOCK_BYTES = 1 << 21  # vectors of one sequence interval, as doubles
FANOUT = 16  # intervals joined to one on the next level
LEAF = 256  # rows compared without another split
SLACK = 1e-9  # rounding room when something is skipped as distant
CHUNK = 4096  # partitions of the sequence numbered together


def usable(vector: Column) -> Column:
    """A double array, or null where the vector is null, empty, zero or holds null or non-finite components."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(doubles) > 0) & finite & F.exists(doubles, lambda x: x != 0), doubles)


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    rows = flat.reshape(-1, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _directions(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Orthonormal leading directions for every vector length in a bounded sample."""
    sample = vectors.orderBy(F.xxhash64("node"), "node").limit(PCA_ROWS).select("v").collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    found = {}
    for dim, rows in by_dim.items():
        u = _unit(np.array(rows, float).ravel(), dim)
        u = u - u.mean(axis=0)
        found[dim] = np.linalg.eigh(u.T @ u)[1][:, ::-1][:, :LEADING].copy()
    return found


def _project(u: np.ndarray, directions: dict[int, np.ndarray]) -> np.ndarray:
    """Leading coordinates of unit vectors and, last, the norm of the rest.

    Two vectors are at least as far apart as their rows here: the rests differ by no less than their norms do.
    """
    dim = u.shape[1]
    axes = directions.get(dim)
    if axes is None:  # a length the sample has not seen
        axes = np.eye(dim)[:, :LEADING]
    p = np.zeros((len(u), BOUNDS))
    lead = u @ axes
    p[:, : axes.shape[1]] = lead
    rest = u - lead @ axes.T  # not from the squares: their difference is not exact enough near zero
    p[:, LEADING] = np.sqrt((rest * rest).sum(axis=1))
    return p


def _packed(flat: np.ndarray) -> bytes:
    """Doubles, or floats where they hold the same values."""
    with np.errstate(over="ignore"):
        single = flat.astype(np.float32)
    return single.tobytes() if (single == flat).all() else flat.tobytes()


def _unpacked(data: bytes, rows: int, dim: int) -> np.ndarray:
    kind = np.float64 if len(data) == 8 * rows * dim else np.float32
    return np.frombuffer(data, kind).astype(np.float64)


def _sequence_blocks(vectors: DataFrame, eps: float, directions: dict[int, np.ndarray]) -> DataFrame:
    """Vectors in epsilon grid order, cut into blocks that hold their bounding box.

    ``vectors`` has ``node``, ``v`` and ``m`` (copies). The order is total (vector length, grid
    cells, node), so a cell with very many vectors spreads over partitions and blocks.
    """
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("v").value_lengths().to_numpy()
            grid = np.zeros((batch.num_rows, LEADING), np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                flat = batch.column("v").take(pa.array(at)).flatten().to_numpy()
                grid[at] = np.floor(_project(_unit(flat, dim), directions)[:, :LEADING] / eps)
            grids = [pa.array(grid[:, k]) for k in range(LEADING)]
            names = ["node", "v", "m", "dim", *[f"c{k}" for k in range(LEADING)]]
            yield pa.RecordBatch.from_arrays([*batch.select(["node", "v", "m"]).columns, pa.array(dims), *grids], names=names)

    order = ["dim", *[f"c{k}" for k in range(LEADING)], "node"]
    gridded = vectors.select("node", "v", "m").mapInArrow(
        cells, "node long, v array<double>, m long, dim int, " + ", ".join(f"c{k} long" for k in range(LEADING))
    )
    total = vectors.agg(F.sum(F.size("v").cast("long")).alias("n")).first()["n"] or 0
    parts = max(1, -(-total * 8 // (4 * BLOCK_BYTES)))
    runs = gridded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    runs = runs.select(F.spark_partition_id().alias("part"), "dim", "node", "v", "m")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {"dim": None, "node": [], "v": [], "m": [], "rows": 0}
        made = 0

        def flush(part: int) -> pa.RecordBatch:
            nonlocal made
            dim = held["dim"]
            node, m = np.concatenate(held["node"]), np.concatenate(held["m"])
            flat = np.concatenate(held["v"])
            p = _project(_unit(flat, dim), directions)
            row = [part << 32 | made, dim, node.tobytes(), m.tobytes(), _packed(flat), p.min(axis=0).tolist(), p.max(axis=0).tolist()]
            made += 1
            held.update(node=[], v=[], m=[], rows=0)
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=["block", "dim", "nodes", "ms", "vs", "lo", "hi"])

        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            dims = batch.column("dim").to_numpy()
            start = 0
            while start < len(dims):
                dim = int(dims[start])
                if held["rows"] and held["dim"] != dim:
                    yield flush(part)
                held["dim"] = dim
                room = max(1, BLOCK_BYTES // (8 * dim)) - held["rows"]
                same = int(np.searchsorted(dims[start:], dim, side="right"))
                piece = batch.slice(start, min(room, same))
                held["node"].append(piece.column("node").to_numpy())
                held["m"].append(piece.column("m").to_numpy())
                held["v"].append(piece.column("v").flatten().to_numpy())
                held["rows"] += piece.num_rows
                start += piece.num_rows
                if piece.num_rows == room:
                    yield flush(part)
        if held["rows"]:
            yield flush(part)

    return runs.mapInArrow(
        cut, "block long, dim int, nodes binary, ms binary, vs binary, lo array<double>, hi array<double>"
    )


def _numbered(blocks: DataFrame) -> DataFrame:
    """Add ``i``, the gapless number from 0 of every block in sequence order, without one task for all blocks.

    Blocks are numbered within their partition already (``block`` holds both), and the partitions are ranges of the
    sequence. Partitions are summed in chunks, so the one unpartitioned window has a row for each 4096 partitions.
    """
    parts = blocks.groupBy(F.shiftright("block", 32).alias("part")).agg(F.count("*").alias("n"))
    parts = parts.withColumn("chunk", F.expr(f"part DIV {CHUNK}"))
    earlier = (Window.unboundedPreceding, -1)
    within = F.sum("n").over(Window.partitionBy("chunk").orderBy("part").rowsBetween(*earlier))
    chunks = parts.groupBy("chunk").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.orderBy("chunk").rowsBetween(*earlier))
    chunks = chunks.select(F.col("chunk").alias("c"), F.coalesce(before, F.lit(0)).alias("before"))
    starts = parts.withColumn("within", F.coalesce(within, F.lit(0))).join(chunks, F.col("chunk") == F.col("c"))
    starts = starts.select("part", (F.col("before") + F.col("within")).alias("start"))
    joined = blocks.join(starts, F.shiftright("block", 32) == F.col("part"))
    return joined.select(*blocks.columns, (F.col("start") + F.col("block").bitwiseAND((1 << 32) - 1)).alias("i"))


def _near_pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """Pairs of blocks (``a`` <= ``b``) whose boxes are no further apart than ``eps``.

    Recursion over intervals of the sequence, one level of FANOUT-fold intervals
    after the other, from the whole sequence down: only children of near pairs
    are compared. Every level is a table with one row per interval.
    """
    low = [F.min(F.col("lo")[k]).alias(f"l{k}") for k in range(BOUNDS)]
    high = [F.max(F.col("hi")[k]).alias(f"h{k}") for k in range(BOUNDS)]
    box = lambda: [F.array(*[f"l{k}" for k in range(BOUNDS)]).alias("lo"), F.array(*[f"h{k}" for k in range(BOUNDS)]).alias("hi")]
    levels = [materialise(_numbered(blocks.select("block", "dim", "lo", "hi")).select("i", "dim", "lo", "hi", "block"), "intervals")]
    count = levels[0].count()
    while count > 1:
        wider = levels[-1].groupBy(F.expr(f"i DIV {FANOUT}").alias("i")).agg(F.min("dim").alias("dim"), *low, *high)
        levels.append(wider.select("i", "dim", *box()))
        count = -(-count // FANOUT)
    gap = F.aggregate(
        F.sequence(F.lit(0), F.lit(BOUNDS - 1)),
        F.lit(0.0),
        lambda s, k: s + F.pow(F.greatest(F.lit(0.0), F.get("alo", k) - F.get("bhi", k), F.get("blo", k) - F.get("ahi", k)), F.lit(2)),
    )
    top = levels.pop()
    pairs = top.select(F.col("i").alias("a"), F.col("i").alias("b"))
    for level in [*reversed(levels)]:
        left = level.select(F.expr(f"i DIV {FANOUT}").alias("pa"), F.col("i").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
        right = level.select(F.expr(f"i DIV {FANOUT}").alias("pb"), F.col("i").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
        parents = pairs.select(F.col("a").alias("pa"), F.col("b").alias("pb"))
        pairs = parents.join(left, "pa").join(right, "pb").where((F.col("a") <= F.col("b")) & (gap <= (eps + SLACK) ** 2)).select("a", "b")
    names = (levels[0] if levels else top).select("i", "block", "dim")
    first = names.select(F.col("i").alias("a"), F.col("block").alias("left"), F.col("dim").alias("da"))
    second = names.select(F.col("i").alias("b"), F.col("block").alias("right"), F.col("dim").alias("db"))
    return pairs.join(first, "a").join(second, "b").where("da = db").select("left", "right")


class _PairJoin:
    """Links between (or within) two blocks: weighted counts and local components."""

    def __init__(self, left: tuple, right: tuple, same: bool, threshold: float, directions: dict[int, np.ndarray]):
        self.same, self.threshold = same, threshold
        self.eps = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
        self.sides = []
        for dim, nodes, ms, vs in (left, right) if not same else (left,):
            ids = np.frombuffer(nodes, np.int64)
            u = _unit(_unpacked(vs, len(ids), dim), dim)
            self.sides.append((ids, np.frombuffer(ms, np.int64), u, _project(u, directions), u.astype(np.float32)))
            # what single precision may lose of a unit vectors' product
            self.least = threshold - (dim + 8) * 2.0**-22
        self.a, self.b = self.sides[0], self.sides[-1]
        self.counts = [np.zeros(len(s[0]), np.int64) for s in self.sides]
        self.shift = 0 if same else len(self.a[0])
        self.parent = np.arange(len(self.a[0]) + (0 if same else len(self.b[0])))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = int(self.parent[x])
        return x

    def join(self, a0: int, a1: int, b0: int, b1: int) -> None:
        """Recursively join two sequence intervals, skipping provably distant ones."""
        pa_, pb = self.a[3][a0:a1], self.b[3][b0:b1]
        gap = np.maximum(0, np.maximum(pa_.min(0) - pb.max(0), pb.min(0) - pa_.max(0)))
        if (gap * gap).sum() > self.eps**2:
            return
        if max(a1 - a0, b1 - b0) <= LEAF:
            self.leaf(a0, a1, b0, b1)
        elif self.same and a0 == b0:
            mid = (a0 + a1) // 2
            self.join(a0, mid, b0, mid)
            self.join(a0, mid, mid, b1)
            self.join(mid, a1, mid, b1)
        elif a1 - a0 >= b1 - b0:
            mid = (a0 + a1) // 2
            self.join(a0, mid, b0, b1)
            self.join(mid, a1, b0, b1)
        else:
            mid = (b0 + b1) // 2
            self.join(a0, a1, b0, mid)
            self.join(a0, a1, mid, b1)

    def leaf(self, a0: int, a1: int, b0: int, b1: int) -> None:
        # the same products in single precision show that most pairs of leaves have no link
        if not self.same or a0 != b0:
            if (self.a[4][a0:a1] @ self.b[4][b0:b1].T).max() < self.least:
                return
        ua, ub = self.a[2][a0:a1], self.b[2][b0:b1]
        cosine = ua @ ub.T
        linked = cosine >= self.threshold
        for i, j in np.argwhere(np.abs(cosine - self.threshold) < 1e-12).tolist():
            linked[i, j] = float(np.sum(ua[i].astype(np.longdouble) * ub[j])) >= self.threshold
        own = self.same and a0 == b0
        if own:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        self.counts[0][a0:a1] += linked @ self.b[1][b0:b1]
        if not own:
            self.counts[-1][b0:b1] += linked.T @ self.a[1][a0:a1]
        # smallest label over all neighbours, until nothing changes
        rows, cols = linked.any(1), linked.any(0)
        linked = linked[rows][:, cols]
        at_row = np.flatnonzero(rows) + a0
        at_col = np.flatnonzero(cols) + b0 + self.shift
        label, far = at_row.copy(), len(self.parent)
        while True:
            of_col = np.where(linked, label[:, None], far).min(0)
            of_row = np.minimum(label, np.where(linked, of_col, far).min(1))
            if (of_row == label).all():
                break
            label = of_row
        for x, y in zip([*at_row.tolist(), *at_col.tolist()], [*label.tolist(), *of_col.tolist()]):
            x, y = self.root(x), self.root(y)
            if x != y:
                self.parent[max(x, y)] = min(x, y)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nodes = np.concatenate([s[0] for s in self.sides])
        counts = np.concatenate(self.counts)
        at = np.flatnonzero(counts)
        peers = np.array([self.root(int(x)) for x in at], np.int64)
        return nodes[at], counts[at], nodes[peers] if len(at) else nodes[at]


def _links(vectors: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``n`` (linked rows, copies counted) and ``peer``, one row per node and block pair with a link."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    directions = _directions(vectors)
    blocks = materialise(_sequence_blocks(vectors, max(eps, 1e-6), directions), "blocks")
    pairs = materialise(_near_pairs(blocks, eps), "block-pairs")
    left = blocks.select(F.col("block").alias("left"), "dim", F.col("nodes").alias("n1"), F.col("ms").alias("m1"), F.col("vs").alias("v1"))
    # a block paired with itself needs its vectors once
    right = blocks.select(F.col("block").alias("right"), F.col("nodes").alias("n2"), F.col("ms").alias("m2"), F.col("vs").alias("v2"))
    apart = pairs.where("left <> right").join(left, "left").join(right, "right")
    alone = pairs.where("left = right").join(left, "left")
    none = F.lit(None).cast("binary")
    both = apart.select("dim", "n1", "m1", "v1", "n2", "m2", "v2").union(
        alone.select("dim", "n1", "m1", "v1", none.alias("n2"), none.alias("m2"), none.alias("v2"))
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                dim, n1, m1, v1, n2, m2, v2 = [batch.column(c)[k].as_py() for c in range(7)]
                work = _PairJoin((dim, n1, m1, v1), (dim, n2, m2, v2), n2 is None, threshold, directions)
                work.join(0, len(work.a[0]), 0, len(work.b[0]))
                nodes, counts, peers = work.result()
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(counts), pa.array(peers)], names=["node", "n", "peer"])

    return both.mapInArrow(compare, "node long, n long, peer long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """One row per vector: how many others it links to, and its group.

    Vectors of the same length link when their cosine, in double precision, is
    ``threshold`` (above 0) or more. ``component_id`` is the smallest id reachable over links,
    ``kept`` marks the row with that id. Vectors that are null, empty or zero or hold
    null or non-finite components, and rows without id, link with nothing: no
    links, their own id, ``kept`` (null ids: false). Repeated rows are vectors of
    their own that link to each other. Other columns are dropped.

    Equal vectors are one node with a count. Nodes are sorted in epsilon grid
    order on the leading principal dimensions and cut into blocks; pairs of
    sequence intervals are joined recursively and skipped when their boxes are
    further apart than the threshold allows. Of the links only counts and a
    spanning set leave a block pair, so a dense group never becomes all its pairs.
    """
    small_batches(rows.sparkSession)
    slim = rows.select(F.col(id_col).cast("long").alias("id"), usable(F.col(vector)).alias("v"))
    taking = slim.where("id is not null and v is not null")
    grouped = taking.groupBy("v").agg(F.count("*").alias("m"), F.min("id").alias("first"))
    nodes = materialise(grouped.withColumn("node", F.monotonically_increasing_id()), "vectors")
    links = materialise(_links(nodes, threshold), "vector-links")
    total = links.groupBy("node").agg(F.sum("n").alias("n"))
    groups = materialise(connected_components(links, "node", "peer"), "vector-groups")
    member = groups.join(nodes.select("node", "first"), "node")
    least = member.groupBy("component").agg(F.min("first").alias("least"))
    named = nodes.join(total, "node", "left").join(member.join(least, "component").select("node", "least"), "node", "left")
    named = named.select(
        F.col("v").alias("w"),
        (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("least", "first").alias("component_id"),
    )
    found = taking.join(named, F.col("v") == F.col("w")).select("id", "n_links", "component_id")
    apart = slim.where("id is null or v is null").select("id", F.lit(0).cast("long"), F.col("id"))
    every = found.union(apart)
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    return every.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"), "component_id", kept)
