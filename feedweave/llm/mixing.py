"""Mixing sources to target weights by Pfair scheduling, with DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedweave.llm.common import materialise, number_in_group

# Blocks the whole corpus is dealt into, besides one more for each source.
BLOCKS = 4096
ADDED = ("pool", "block", "slot", "release", "deadline", "position")

# Per pool the release time and deadline of each of its blocks. While a pool is
# alive it gets its weight's share of all live pools, so when block j of pool p
# is through, pool q has had min(w_q * j / w_p, its blocks): the sum over q is
# the time. All numbers are whole, so floor and ceiling are exact.
_WINDOWS = """
transform(pools, p -> transform(
    CASE WHEN p.blocks > 0 THEN sequence(0L, p.blocks - 1L) ELSE array() END,
    j -> named_struct(
        'release', aggregate(pools, 0L, (a, q) -> a + least(q.weight * j, q.blocks * p.weight)) DIV p.weight,
        'deadline', (aggregate(pools, 0L, (a, q) -> a + least(q.weight * (j + 1L), q.blocks * p.weight))
                     + p.weight - 1L) DIV p.weight)))
"""
# Earliest deadline first: each slot goes to the released next block with the
# smallest deadline, ties to the pool listed first.
_SCHEDULE = """
aggregate(
    CASE WHEN total > 0 THEN sequence(0L, total - 1L) ELSE array() END,
    named_struct('done', transform(pools, p -> 0), 'picks', CAST(array() AS array<int>)),
    (s, t) -> transform(
        array(array_min(filter(
            transform(windows, (w, i) -> named_struct('deadline', get(w, s.done[i]).deadline, 'pool', i,
                                                      'ready', coalesce(get(w, s.done[i]).release <= t, false))),
            c -> c.ready)).pool),
        pick -> named_struct('done', transform(s.done, (d, i) -> d + CASE WHEN i = pick THEN 1 ELSE 0 END),
                             'picks', concat(s.picks, array(pick))))[0]).picks
"""


def _named(weights: dict[str, int], other_weight: int) -> list[tuple[str | None, int]]:
    pools = [(name, int(weights[name])) for name in sorted(weights)] + [(None, int(other_weight))]
    if any(w <= 0 for _, w in pools):
        raise ValueError("target weights must be positive whole numbers")
    return pools


def schedule(spark: SparkSession, rows: list[int], pool_weights: list[int], size: int) -> DataFrame:
    """The slot of every block: ``pool``, ``block``, ``slot``, ``release``, ``deadline``, ``rows_before``.

    Pools are numbered from 0 in the order of ``rows`` and ``pool_weights``; a block holds ``size``
    rows, the last of a pool what is left. ``rows_before`` counts the rows of all earlier slots.
    """
    pools = ", ".join(
        f"named_struct('weight', {w}L, 'rows', {n}L, 'blocks', {-(-n // size)}L)" for w, n in zip(pool_weights, rows)
    )
    total = sum(-(-n // size) for n in rows)
    one = spark.range(1).selectExpr(f"array({pools}) AS pools", f"id + {total}L AS total")
    # a table of one row, so that the windows are computed once and not in each slot
    windows = materialise(one.selectExpr("pools", "total", f"{_WINDOWS} AS windows"), "windows")
    due = windows.selectExpr("pools", "posexplode(windows) AS (number, due)").selectExpr(
        "number", "pools[number].rows AS rows", "posexplode(due) AS (block, w)"
    )
    slots = windows.selectExpr(f"{_SCHEDULE} AS picks").selectExpr("posexplode(picks) AS (slot, number)")
    turns = slots.selectExpr(
        "number",
        "CAST(slot AS bigint) AS slot",
        "CAST(row_number() OVER (PARTITION BY number ORDER BY slot) - 1 AS int) AS block",
    )
    numbered = turns.join(due, ["number", "block"]).selectExpr(
        "number", "block", "slot", "w.release", "w.deadline", f"least({size}L, rows - block * {size}L) AS size"
    )
    before = "sum(size) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return numbered.selectExpr("*", f"coalesce({before}, 0L) AS rows_before").drop("size")


def mix(
    docs: DataFrame,
    weights: dict[str, int],
    other_weight: int = 1,
    source: str = "source",
    id_col: str = "doc_id",
    ties: str = "text",
    blocks: int = BLOCKS,
) -> DataFrame:
    """Interleave all rows so that every prefix follows the sources' target weights.

    Each source named in ``weights`` is a pool; all other sources, null included,
    share one pool of weight ``other_weight``. A pool's rows are shuffled by a hash of the
    id and cut into blocks. Pool p with share s of the live pools' weights has block j
    released at floor(j / s) and due at ceil((j + 1) / s); when a pool runs out, the others
    share its time in proportion. Slots go to released blocks by earliest deadline, which
    meets all deadlines, so at any slot every pool is less than one block from its
    ideal. No row is dropped or repeated, however the weights fit the supply.

    Adds ``pool`` (the source's name, null for the shared pool), ``block`` (within the
    pool), ``slot``, ``release``, ``deadline`` and ``position`` (gapless from 0 over all rows);
    input columns of these names are replaced. Null ids come first in their slice; rows that
    repeat an id are ordered by the ``ties`` column, fully equal rows in any order.
    An empty table gives an empty result.
    """
    pools = _named(weights, other_weight)
    rest = docs.select(*[c for c in docs.columns if c.lower() not in ADDED])
    number = F.lit(len(pools) - 1)
    for k, (name, _) in enumerate(pools[:-1]):
        number = F.when(F.col(source) == name, k).otherwise(number)
    pooled = rest.withColumn("__pool", number)
    # at most one row for each pool
    counts = {r["__pool"]: r["n"] for r in pooled.groupBy("__pool").agg(F.count("*").alias("n")).collect()}
    rows = [counts.get(k, 0) for k in range(len(pools))]
    size = max(1, -(-sum(rows) // blocks))
    slots = materialise(schedule(docs.sparkSession, rows, [w for _, w in pools], size), "schedule")
    names = F.array(*[F.lit(name).cast("string") for name, _ in pools])
    slots = slots.select(
        F.col("number").alias("__n"),
        F.get(names, F.col("number")).alias("pool"),
        "block",
        "slot",
        "release",
        "deadline",
        "rows_before",
    )
    numbered = number_in_group(pooled, "__pool", id_col, [F.md5(F.col(ties).cast("string"))], "__index")
    # the schedule has at most `blocks` rows and one more for each pool
    placed = numbered.join(
        F.broadcast(slots), (F.col("__pool") == F.col("__n")) & (F.expr(f"__index DIV {size}L") == F.col("block"))
    )
    return placed.withColumn("position", F.col("rows_before") + F.col("__index") % size).drop(
        "__pool", "__n", "__index", "rows_before"
    )


def in_mixed_order(docs: DataFrame, weights: dict[str, int], **options: object) -> DataFrame:
    """The same rows with the same columns, sorted by their position in the mix."""
    clash = {c: f"__own_{k}" for k, c in enumerate(docs.columns) if c.lower() in ADDED}
    mixed = mix(docs.withColumns({new: F.col(c) for c, new in clash.items()}), weights, **options)
    return mixed.orderBy("position").select(*[F.col(clash.get(c, c)).alias(c) for c in docs.columns])
