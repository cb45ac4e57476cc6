"""Exact top-k inner products: dual-tree search over cover trees of queries and candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweave.llm.common import bounded_batches, materialise

PIVOTS = 64  # centres of the top level, from a bounded sample of vectors
SAMPLE_ROWS = 2048
BLOCK_BYTES = 4 << 20  # vectors of one tree at most, as 8-byte numbers
BLOCK_ROWS = 2048  # and their number: building a tree takes all distances among them
QUERY_ROWS = 512
SLICES = 8  # the candidate trees of one query tree are searched in so many runs
LEAF = 64  # points of a leaf
FAN_BITS = 4  # a ball over balls takes in 2 ** FAN_BITS neighbours in the order of the blocks
BEAM = 8  # balls of a level in which a query block looks for its home; decides speed only
_KIND = "block long, dim int, n int, ids binary, vs binary, nodes binary, balls binary, centre binary, radius double"


class CoverTree:
    """A cover tree over integer vectors whose rows are reordered depth first.

    A node is a range of rows around one of its points, the centre, with the
    largest distance from it as covering radius. Children of a node are centres
    more than half its scale apart, the node's own centre among them; each takes
    the points within half the scale. Children of one point share a leaf.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.rows, self.ids = rows.astype(np.float64), ids
        self.order: list[np.ndarray] = []
        self.nodes: list[list[int]] = []  # start, end, centre (original row), parent
        self.radii: list[float] = []
        if len(ids):
            middle = self.rows.mean(axis=0)
            start = int(((self.rows - middle) ** 2).sum(axis=1).argmin())
            self._grow(np.arange(len(ids)), start)

    def _distances(self, points: np.ndarray, centre: int) -> np.ndarray:
        return np.sqrt(((self.rows[points] - self.rows[centre]) ** 2).sum(axis=1))

    def _grow(self, points: np.ndarray, centre: int) -> None:
        done = 0
        stack = [(points, centre, -1, -1.0)]
        while stack:
            points, centre, parent, scale = stack.pop()
            away = self._distances(points, centre)
            radius = float(away.max())
            me = len(self.nodes)
            self.nodes.append([done, done + len(points), centre, parent])
            self.radii.append(radius)
            if len(points) <= LEAF or radius == 0:
                self.order.append(points)
                done += len(points)
                continue
            scale = (scale if 0 < scale <= 2 * radius else radius) / 2
            own = self.rows[points]
            square = (own * own).sum(axis=1)
            near = square[:, None] + square - 2 * (own @ own.T) <= scale * scale
            np.fill_diagonal(near, True)
            children, lone = [], []
            left = np.ones(len(points), bool)
            at = int(np.flatnonzero(points == centre)[0])
            while True:
                taken = np.flatnonzero(near[at] & left)
                if len(taken) > 1:
                    children.append((points[taken], int(points[at]), me, scale))
                else:
                    lone.append(points[taken])
                left[taken] = False
                at = int(left.argmax())
                if not left[at]:
                    break
            if lone:
                singles = np.concatenate(lone)
                if len(singles) == len(points):  # nothing left to cover more tightly
                    pieces = np.array_split(singles, -(-len(singles) // LEAF))
                    children = [(piece, int(piece[0]), me, -2.0) for piece in pieces]
                else:
                    children.append((singles, int(singles[0]), me, scale))
            stack.extend(reversed(children))

    def packed(self) -> tuple[np.ndarray, np.ndarray]:
        """The new order of the rows, and the nodes with centres counted in it."""
        order = np.concatenate([*self.order, np.empty(0, np.int64)]).astype(np.int64)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        nodes = np.array(self.nodes, np.int64).reshape(-1, 4)
        nodes[:, 2] = place[nodes[:, 2]]
        return order, nodes


class _Tree:
    """A stored tree, ready for the search."""

    def __init__(self, dim: int, n: int, ids: bytes, vs: bytes, nodes: bytes, balls: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        kind = np.int64 if len(vs) == 8 * n * dim else np.int32
        self.exact = np.frombuffer(vs, kind).reshape(n, dim).astype(np.int64)
        self.largest = int(np.abs(self.exact).max()) if n else 0
        self.rows = self.exact.astype(np.float64)
        self.nodes = np.frombuffer(nodes, np.int64).reshape(-1, 4)
        self.radii = np.frombuffer(balls)
        self.centres = self.rows[self.nodes[:, 2]]
        self.norms = np.sqrt((self.centres**2).sum(axis=1))
        self.children: list[list[int]] = [[] for _ in self.nodes]
        for k, parent in enumerate(self.nodes[:, 3].tolist()):
            if parent >= 0:
                self.children[parent].append(k)


class DualSearch:
    """All queries of one tree against trees of candidates, one after the other."""

    def __init__(self, queries: _Tree, k: int, worst: np.ndarray):
        self.q, self.k = queries, k
        n = len(queries.ids)
        self.scores = np.full((n, k), np.iinfo(np.int64).min, np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.worst = worst  # of each query: a score that k candidates are known to reach

    def against(self, candidates: _Tree) -> None:
        """Search one more tree of candidates."""
        self.c, queries = candidates, self.q
        n, dim = len(queries.ids), queries.rows.shape[1]
        self.in_doubles = queries.largest * candidates.largest * dim < 1 << 53
        if not self.in_doubles and queries.largest * candidates.largest * dim >= 1 << 63:
            raise ValueError("scores exceed 64 bits")
        if n and len(candidates.ids):
            self._visit(0, np.zeros(1, np.int64))

    def _bounds(self, q: int, cs: np.ndarray) -> np.ndarray:
        """No candidate below these nodes scores higher for any query below q."""
        rq, rc = self.q.radii[q], self.c.radii[cs]
        raw = self.c.centres[cs] @ self.q.centres[q] + self.q.norms[q] * rc + self.c.norms[cs] * rq + rq * rc
        return raw + 1e-9 * (np.abs(raw) + (self.q.norms[q] + rq) * (self.c.norms[cs] + rc)) + 1e-6

    def _visit(self, q: int, cs: np.ndarray) -> None:
        a, b = self.q.nodes[q, 0], self.q.nodes[q, 1]
        bounds = self._bounds(q, cs)
        for i in np.argsort(-bounds).tolist():
            if bounds[i] < self.worst[a:b].min():  # the rest is bounded lower still
                return
            c = int(cs[i])
            below_q, below_c = self.q.children[q], self.c.children[c]
            if not below_q and not below_c:
                self._compare(a, b, self.c.nodes[c, 0], self.c.nodes[c, 1])
            elif below_c and (not below_q or self.c.radii[c] >= self.q.radii[q]):
                self._visit(q, np.array(below_c))
            else:
                for child in below_q:
                    self._visit(child, cs[i : i + 1])

    def _compare(self, a: int, b: int, c: int, d: int) -> None:
        if self.in_doubles:
            found = (self.q.rows[a:b] @ self.c.rows[c:d].T).astype(np.int64)
        else:
            found = self.q.exact[a:b] @ self.c.exact[c:d].T
        ids = self.c.ids[c:d]
        enters = (found >= self.worst[a:b, None]) & (ids[None, :] != self.q.ids[a:b, None])
        rows = np.flatnonzero(enters.any(axis=1))
        if not len(rows):
            return
        lowest = np.iinfo(np.int64)
        scores = np.concatenate([self.scores[a + rows], np.where(enters[rows], found[rows], lowest.min)], axis=1)
        names = np.concatenate([self.ids[a + rows], np.where(enters[rows], ids[None, :], lowest.max)], axis=1)
        best = np.lexsort((names, ~scores), axis=1)[:, : self.k]
        self.scores[a + rows] = np.take_along_axis(scores, best, axis=1)
        self.ids[a + rows] = np.take_along_axis(names, best, axis=1)
        self.worst[a + rows] = np.maximum(self.worst[a + rows], self.scores[a + rows, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        full = self.ids != np.iinfo(np.int64).max
        return np.repeat(self.q.ids, full.sum(axis=1)), self.ids[full], self.scores[full]


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, or null where the vector takes no part."""
    doubles = vector.cast("array<double>")
    finite = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite & (F.size(doubles) > 0), F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _in_sequence(rows: np.ndarray) -> np.ndarray:
    """An order in which neighbours are near: halves along the line between two far ends, halved again."""
    waiting, order = [np.arange(len(rows))], []
    while waiting:
        at = waiting.pop()
        if len(at) < 3:
            order += at.tolist()
            continue
        one = at[((rows[at] - rows[at[0]]) ** 2).sum(axis=1).argmax()]
        two = at[((rows[at] - rows[one]) ** 2).sum(axis=1).argmax()]
        at = at[np.argsort(rows[at] @ (rows[two] - rows[one]), kind="stable")]
        waiting += [at[len(at) // 2 :], at[: len(at) // 2]]
    return np.array(order)


def _pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Centres far apart from each other, per vector length, from a bounded sample, neighbours next to each other."""
    by_dim: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").collect():
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    found = {}
    for dim, rows in by_dim.items():
        rows = np.array(rows, float)
        at, away = [0], ((rows - rows[0]) ** 2).sum(axis=1)
        while len(at) < PIVOTS and away.max() > 0:
            at.append(int(away.argmax()))
            away = np.minimum(away, ((rows - rows[at[-1]]) ** 2).sum(axis=1))
        found[dim] = rows[at][_in_sequence(rows[at])]
    return found


def _trees(vectors: DataFrame, pivots: dict[int, np.ndarray], block_rows: int) -> DataFrame:
    """Blocks of vectors that lie around the same pivots, each with its cover tree.

    The order (length, nearest pivot, second nearest, distance, id) is total, so
    a pivot with very many vectors spreads over partitions and blocks.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("v").value_lengths().to_numpy()
            pivot, second, away = np.zeros(len(dims), np.int64), np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                rows = batch.column("v").take(pa.array(at)).flatten().to_numpy().reshape(-1, dim).astype(float)
                centres = pivots.get(dim, np.zeros((1, dim)))
                square = (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)
                pivot[at], away[at] = square.argmin(axis=1), square.min(axis=1)
                square[np.arange(len(at)), pivot[at]] = np.inf
                second[at] = square.argmin(axis=1)
            added = [pa.array(x) for x in (dims, pivot, second, away)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=["id", "v", "dim", "pivot", "second", "away"])

    total = vectors.agg(F.sum(F.size("v").cast("long")).alias("n")).first()["n"] or 0
    order = ["dim", "pivot", "second", "away", "id"]
    placed = vectors.select("id", "v").mapInArrow(place, "id long, v array<long>, dim int, pivot long, second long, away double")
    parts = max(1, -(-total * 8 // (2 * BLOCK_BYTES)))
    runs = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    runs = runs.select(F.spark_partition_id().alias("part"), "dim", "id", "v")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0

        def tree(part: int, dim: int, ids: list, vs: list) -> pa.RecordBatch:
            names, rows = np.concatenate(ids), np.concatenate(vs).reshape(-1, dim)
            built = CoverTree(names, rows)
            order, nodes = built.packed()
            names, rows = names[order], rows[order]
            small = np.abs(rows).max() < 1 << 31
            centre = rows[nodes[0, 2]].astype(np.float64)
            row = [part << 32 | made, dim, len(names), names.tobytes(), (rows.astype(np.int32) if small else rows).tobytes()]
            row += [nodes.tobytes(), np.array(built.radii).tobytes(), centre.tobytes(), built.radii[0]]
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=[f.split()[0] for f in _KIND.split(", ")])

        part, dim, held, ids, vs = 0, 0, 0, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            dims = batch.column("dim").to_numpy()
            start = 0
            while start < len(dims):
                if held and dim != dims[start]:
                    yield tree(part, dim, ids, vs)
                    made, held, ids, vs = made + 1, 0, [], []
                dim = int(dims[start])
                room = max(1, min(block_rows, BLOCK_BYTES // (8 * dim))) - held
                piece = batch.slice(start, min(room, int(np.searchsorted(dims[start:], dim, side="right"))))
                ids.append(piece.column("id").to_numpy())
                vs.append(piece.column("v").flatten().to_numpy())
                held, start = held + piece.num_rows, start + piece.num_rows
                if piece.num_rows == room:
                    yield tree(part, dim, ids, vs)
                    made, held, ids, vs = made + 1, 0, [], []
        if held:
            yield tree(part, dim, ids, vs)

    return runs.mapInArrow(grow, _KIND)


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Dual-tree search in every pair of trees; ``q_worst`` may hold known kth scores of the queries.

    Pairs that follow each other with the same ``q_block`` and ``slice`` share their best
    results and bounds, and give one set of results.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = found = None

        def result() -> pa.RecordBatch:
            q, c, score = found.rows()
            block = pa.array(np.full(len(q), now[0]))
            return pa.RecordBatch.from_arrays([block, pa.array(q), pa.array(c), pa.array(score)], names=["q_block", "query_id", "vec_id", "score"])

        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r].as_py() for name in ("q_block", "slice", "dim", "most", "q_n", "c_n", "q_worst")}
                tree = lambda side: _Tree(row["dim"], row[f"{side}_n"], *[batch.column(f"{side}_{f}")[r].as_py() for f in ("ids", "vs", "nodes", "balls")])
                if now != (row["q_block"], row["slice"]):
                    if found is not None:
                        yield result()
                    now, queries = (row["q_block"], row["slice"]), tree("q")
                    worst = np.full(row["q_n"], np.iinfo(np.int64).min, np.int64)
                    if row["q_worst"] is not None:
                        known = np.array(batch.column("q_known")[r].as_py(), np.int64)
                        worst = np.array(row["q_worst"], np.int64)[np.searchsorted(known, queries.ids)]
                    found = DualSearch(queries, k, worst)
                if row["most"] >= found.worst.min():
                    found.against(tree("c"))
        if found is not None:
            yield result()

    return pairs.mapInArrow(search, "q_block long, query_id long, vec_id long, score long")


def _side(trees: DataFrame, side: str) -> DataFrame:
    return trees.select(*[F.col(c).alias(f"{side}_{c}") for c in ("block", "n", "ids", "vs", "nodes", "balls")])


def _around(balls: pa.Table) -> pa.Table:
    """One ball around all balls of a group, whose members share ``dim`` and ``up``."""
    centres = np.array([np.frombuffer(x) for x in balls.column("centre").to_pylist()])
    n = balls.column("n").to_numpy().astype(np.float64)
    centre = (centres * n[:, None]).sum(axis=0) / n.sum()
    radius = (np.sqrt(((centres - centre) ** 2).sum(axis=1)) + balls.column("radius").to_numpy()).max()
    row = [balls.column("dim")[0].as_py(), balls.column("up")[0].as_py(), int(n.sum()), centre.tobytes(), float(radius)]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.float64()]
    return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=["dim", "node", "n", "centre", "radius"])


def _levels(trees: DataFrame) -> list[DataFrame]:
    """Balls around the blocks, then balls around neighbouring balls, up to one ball for each vector length.

    The upper half of a block's number is its partition in the order of the
    vectors, so the partition is the first ball above and runs of partitions the
    next ones. A group holds the blocks of one partition, or ``2 ** FAN_BITS`` balls.
    """
    level = trees.select("dim", F.col("block").alias("node"), F.col("n").cast("long").alias("n"), "centre", "radius", F.expr("shiftright(block, 32)").alias("up"))
    levels = [level]
    last = (trees.agg(F.max("block").alias("b")).first()["b"] or 0) >> 32
    while True:
        above = level.groupBy("dim", "up").applyInArrow(_around, "dim int, node long, n long, centre binary, radius double")
        level = materialise(above.withColumn("up", F.expr(f"shiftright(node, {FAN_BITS})")), "balls")
        levels.append(level)
        if not last:
            return levels
        last >>= FAN_BITS


def _reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The centres' product and the most that any two points of two balls can reach."""
    for batch in batches:
        centres = [[np.frombuffer(x) for x in batch.column(f"{s}_centre").to_pylist()] for s in "qc"]
        dots = np.array([x @ y for x, y in zip(*centres)], np.float64)
        q, c = [np.array([np.sqrt(x @ x) for x in side], np.float64) for side in centres]
        rq, rc = batch.column("q_radius").to_numpy(), batch.column("c_radius").to_numpy()
        most = dots + q * rc + c * rq + rq * rc
        most = most + 1e-9 * (np.abs(most) + (q + rq) * (c + rc)) + 1e-6
        kept = [batch.column(f.split()[0]) for f in _REACH.split(", ")[:-2]]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(dots), pa.array(most)], names=[f.split()[0] for f in _REACH.split(", ")])


_REACH = "dim int, q_block long, q_centre binary, q_radius double, least long, node long, c_n long, dot double, most double"


def _below(met: DataFrame, level: DataFrame) -> DataFrame:
    """Every query block of ``met`` with the balls one level below the ball it met."""
    balls = level.select(
        "dim", F.col("up").alias("node"), F.col("node").alias("child"),
        F.col("n").alias("c_n"), F.col("centre").alias("c_centre"), F.col("radius").alias("c_radius"),
    )
    carried = met.select("dim", "q_block", "q_centre", "q_radius", "least", "node")
    pairs = carried.join(balls, ["dim", "node"]).drop("node").withColumnRenamed("child", "node")
    return pairs.mapInArrow(_reach, _REACH)


def top_k(
    rows: DataFrame,
    queries: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` best candidates of every query by integer inner product, exactly.

    Vectors become floor(scale * x); those that are null, empty, or hold null or
    non-finite components, and rows without id, take no part, neither as query nor as
    candidate. ``queries`` is a condition on the id column named ``id``; candidates are
    all rows with another id and the same vector length. Of rows with the same id one counts, with
    the smallest vector. Ties go to the smaller id. With fewer candidates than
    ``k`` all are returned; an empty table gives no rows. Scores that may leave 64 bits
    raise an error. Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``.

    Queries and candidates are cut into blocks around common pivots, each with
    a cover tree. Balls around neighbouring blocks, and balls around these, form
    a tree above the blocks. Every query block first descends to the block that
    promises most and searches it; the kth scores found there bound all later
    work: balls, blocks, then node pairs, whose centres and covering radii cannot
    reach the worst kth score of the query group are skipped with all below them.
    """
    bounded_batches(rows.sparkSession)
    slim = rows.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector), scale).alias("v"))
    slim = slim.where("id is not null and v is not null").groupBy("id").agg(F.min("v").alias("v"))
    vectors = materialise(slim, "vectors")
    asked = vectors.where(queries)
    pivots = _pivots(vectors)
    candidates = materialise(_trees(vectors, pivots, BLOCK_ROWS), "candidate-trees")
    wanted = materialise(_trees(asked, pivots, QUERY_ROWS), "query-trees")

    # the home block: the most promising of the most promising balls, level by level
    levels = _levels(candidates)[::-1]
    asking = wanted.select(
        "dim", F.col("block").alias("q_block"), F.col("centre").alias("q_centre"), F.col("radius").alias("q_radius"), F.lit(0).cast("long").alias("node")
    )
    met = asking.withColumn("least", F.lit(None).cast("long"))
    promise = Window.partitionBy("q_block").orderBy(F.desc(F.col("c_n") > k), F.desc("dot"), F.desc("node"))
    for level in levels:
        beam = 1 if level is levels[-1] else BEAM
        met = _below(met, level).withColumn("place", F.row_number().over(promise)).where(F.col("place") <= beam)
    home = materialise(met.select("q_block", F.col("node").alias("c_block"), "most", F.lit(0).alias("slice")), "homes")
    own, theirs = _side(wanted, "q"), _side(candidates, "c")
    nothing = [F.lit(None).cast("array<long>").alias(c) for c in ("q_known", "q_worst")]
    dims = wanted.select(F.col("block").alias("q_block"), "dim")
    seed = home.join(dims, "q_block").join(own, "q_block").join(theirs, "c_block").select("*", *nothing)
    first = materialise(_search(seed, k), "first-results")

    kth = first.groupBy("q_block", "query_id").agg(
        F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(-(1 << 63)).cast("long")).alias("worst")
    )
    # a query without any result so far has no bound either
    ids = wanted.select(F.col("block").alias("q_block"), "ids").mapInArrow(_ids, "q_block long, query_id long")
    known = ids.join(kth, ["q_block", "query_id"], "left").select(
        "q_block", "query_id", F.coalesce("worst", F.lit(-(1 << 63)).cast("long")).alias("worst")
    )
    # as many entries as a query block has queries
    known = known.groupBy("q_block").agg(
        F.array_sort(F.collect_list(F.struct("query_id", "worst"))).alias("known"), F.min("worst").alias("least")
    )
    known = materialise(known, "known-scores")
    # only balls that can reach a query block's worst kth score are opened
    met = asking.join(known.select("q_block", "least"), "q_block")
    for level in levels:
        met = _below(met, level).where("most >= least")
    pairs = materialise(met.select("q_block", F.col("node").alias("c_block"), "most"), "block-pairs")
    left = pairs.join(home.select("q_block", F.col("c_block").alias("home")), "q_block").where("c_block <> home")
    left = left.join(known, "q_block").join(dims, "q_block").select(
        "dim", "q_block", "c_block", "most", F.pmod(F.xxhash64("c_block"), F.lit(SLICES)).cast("int").alias("slice"),
        F.col("known.query_id").alias("q_known"), F.col("known.worst").alias("q_worst"),
    )
    # a run of trees, the most promising first, gives k results a query at most
    runs = left.join(own, "q_block").join(theirs, "c_block").repartition("q_block", "slice")
    second = _search(runs.sortWithinPartitions("q_block", "slice", F.desc("most")), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    every = first.union(second).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return every.select("query_id", "rank", "vec_id", "score")


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            of = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(of), block)), pa.array(of)], names=["q_block", "query_id"])
