"""Sharding by a k-d tree over document metadata with distributed weighted medians."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedweave.llm.common import materialise, number_in_group

BINS = 1024  # histogram bins of one median step
TIE_MAX = (1 << 62) - 1


@dataclass
class Node:
    """A leaf with its shard number, or a split: keys up to (value, tie) go left."""

    leaves: int
    shard: int = -1
    dim: int = -1
    value: int = 0
    tie: int = 0
    left: "Node | None" = None
    right: "Node | None" = None


@dataclass
class _Median:
    """Narrows the split key of one node; first the value, then the tie of one value."""

    node: Node
    number: int
    dim: int
    goal: int
    lo: int
    hi: int
    value: int | None = None
    below: int = 0
    done: bool = field(default=False)

    @property
    def width(self) -> int:
        return max(1, -(-(self.hi - self.lo + 1) // BINS))

    def narrow(self, bins: list) -> None:
        for b in sorted(bins, key=lambda r: r["bin"]):
            if self.below + b["size"] < self.goal and b is not bins[-1]:
                self.below += b["size"]
                continue
            if b["lo"] < b["hi"]:
                self.lo, self.hi = b["lo"], b["hi"]
            elif self.value is None:
                self.value, self.lo, self.hi = b["lo"], 0, TIE_MAX
            else:
                nearer = abs(self.below + b["size"] - self.goal) <= abs(self.goal - self.below)
                self.node.dim, self.node.value = self.dim, self.value
                self.node.tie = b["lo"] if nearer else b["lo"] - 1
                self.done = True
            return


def code(column: Column) -> Column:
    """A number for a metadata value: numbers as they are, a fixed hash for text; nulls before all others."""
    return F.coalesce(F.crc32(column.cast("string")), F.lit(-1)).cast("long")


def measured(docs: DataFrame, id_col: str, text: str, numbers: list[str], names: list[str]) -> DataFrame:
    """Adds ``__size`` (UTF-8 bytes plus 1), ``__crc``, ``__tie`` and the dimensions ``__d0``, ``__d1``, ..."""
    data = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    whole = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1))
    dims = [whole(c) for c in numbers] + [code(F.col(c)) for c in names]
    sized = docs.withColumns({"__size": (F.octet_length(data) + 1).cast("long"), "__crc": F.crc32(data)})
    tie = F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string"), "__crc"), 2)
    return sized.withColumns({"__tie": tie} | {f"__d{k}": d for k, d in enumerate(dims)})


def assign(tree: Node) -> Column:
    """The shard of a measured row."""
    if tree.dim < 0:
        return F.lit(tree.shard)
    key = F.col(f"__d{tree.dim}")
    goes_left = (key < tree.value) | ((key == tree.value) & (F.col("__tie") <= tree.tie))
    return F.when(goes_left, assign(tree.left)).otherwise(assign(tree.right))


def _number_of(tree: Node, open_nodes: list[Node]) -> Column:
    """Which of the open nodes a row lies in; null if in none."""
    for k, node in enumerate(open_nodes):
        if node is tree:
            return F.lit(k)
    if tree.dim < 0:
        return F.lit(None).cast("int")
    key = F.col(f"__d{tree.dim}")
    goes_left = (key < tree.value) | ((key == tree.value) & (F.col("__tie") <= tree.tie))
    return F.when(goes_left, _number_of(tree.left, open_nodes)).otherwise(_number_of(tree.right, open_nodes))


def build_tree(points: DataFrame, dims: int, shards: int | None, target_bytes: int | None) -> Node:
    """Split at weighted medians along the widest dimension until leaves have the target bytes.

    ``points`` are measured rows. A node for n leaves gives floor(n / 2) / n of its bytes to
    the left. Its dimension is the one with the largest spread, relative to
    the spread of all rows (ties: the first). The median is exact: histograms of
    the interval that holds it are summed by executors, all nodes of a level in one
    job, until one key is left; the driver sees at most BINS rows a node.
    """
    stats = [f(f"__d{k}").alias(f"{n}{k}") for k in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]
    whole = points.agg(F.sum("__size").alias("size"), *stats).first()
    if shards is None:
        shards = max(1, -(-(whole["size"] or 0) // max(1, target_bytes or 1)))
    root = Node(shards)
    spread = [max(1, (whole[f"hi{k}"] or 0) - (whole[f"lo{k}"] or 0)) for k in range(dims)]
    level = [root] if shards > 1 and whole["size"] else []
    while level:
        placed = points.withColumn("__node", _number_of(root, level)).where("__node is not null")
        found = {r["__node"]: r for r in placed.groupBy("__node").agg(F.sum("__size").alias("size"), *stats).collect()}
        medians = []
        for k, node in enumerate(level):
            if (r := found.get(k)) is None:
                continue  # no rows: the node stays one leaf, its other shards stay empty
            dim = max(range(dims), key=lambda d: ((r[f"hi{d}"] - r[f"lo{d}"]) / spread[d], -d))
            goal = r["size"] * (node.leaves // 2) // node.leaves
            medians.append(_Median(node, k, dim, goal, r[f"lo{dim}"], r[f"hi{dim}"]))
        while open_ := [m for m in medians if not m.done]:
            key, low, width = F.lit(None).cast("long"), F.lit(0).cast("long"), F.lit(1).cast("long")
            for m in open_:
                here = F.col("__node") == m.number
                if m.value is None:
                    x = F.col(f"__d{m.dim}")
                else:
                    x = F.when(F.col(f"__d{m.dim}") == m.value, F.col("__tie"))
                key = F.when(here & x.between(m.lo, m.hi), x).otherwise(key)
                low = F.when(here, F.lit(m.lo).cast("long")).otherwise(low)
                width = F.when(here, F.lit(m.width).cast("long")).otherwise(width)
            keyed = placed.select("__node", "__size", key.alias("x"), low.alias("l"), width.alias("w")).where("x is not null")
            binned = keyed.groupBy("__node", F.expr("(x - l) DIV w").alias("bin")).agg(
                F.sum("__size").alias("size"), F.min("x").alias("lo"), F.max("x").alias("hi")
            )
            rows: dict[int, list] = {}
            for r in binned.collect():
                rows.setdefault(r["__node"], []).append(r)
            for m in open_:
                m.narrow(sorted(rows[m.number], key=lambda r: r["bin"]))
        level = []
        for m in medians:
            first = m.node.leaves // 2
            m.node.left, m.node.right = Node(first), Node(m.node.leaves - first)
            level += [n for n in (m.node.left, m.node.right) if n.leaves > 1]
    _name(root, 0)
    return root


def _name(node: Node, first: int) -> None:
    node.shard = first
    if node.dim >= 0:
        _name(node.left, first)
        _name(node.right, first + node.left.leaves)


def shard(
    docs: DataFrame,
    shards: int | None = 16,
    target_bytes: int | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    numbers: tuple[str, ...] = ("n_chars",),
    names: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """Put every row into a shard of nearly equal bytes whose rows have similar metadata.

    Give a number of ``shards``, or ``target_bytes`` from which it follows. Dimensions are the
    whole-number columns ``numbers`` and the text columns ``names``; null metadata come before all
    values. Size is the UTF-8 bytes of the whole text (null: none) plus 1. A split falls
    between two keys (value, hash of id and text), so rows that agree in all metadata are still
    separated, whatever share of the bytes they hold; only rows that repeat id and text stay
    together. Shards differ by no more than the documents at their borders. Adds ``shard`` (from
    0), ``slot`` (gapless from 0 within the shard), ``size`` and ``text_crc32``; input columns of these
    names are replaced. An empty table stays empty.
    """
    added = ("shard", "slot", "size", "text_crc32")
    rest = docs.select(*[c for c in docs.columns if c.lower() not in added])
    rows = measured(rest, id_col, text, list(numbers), list(names))
    dims = len(numbers) + len(names)
    points = materialise(rows.select("__size", "__tie", *[f"__d{k}" for k in range(dims)]), "points")
    tree = build_tree(points, dims, shards, target_bytes)
    placed = rows.withColumn("shard", assign(tree).cast("int"))
    placed = placed.drop("__tie", *[f"__d{k}" for k in range(dims)])
    placed = placed.withColumnRenamed("__size", "size").withColumnRenamed("__crc", "text_crc32")
    return number_in_group(placed, "shard", id_col, [F.col("text_crc32")], "slot")
