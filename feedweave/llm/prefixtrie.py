"""Prefix trie of conversations: burst tries whose containers are sorted and swept into nodes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedweave.llm.common import bounded_batches, materialise

# Turns that the suffixes of a container may hold; a larger one is burst.
CONTAINER_TURNS = 2048
# Ids joined into one text when the ids that end at a trie head are hashed.
ENDS_RUN = 20_000
# A turn id: 16 bytes of a SHA-256 of role and text, and the number of words of the text.
TURN_BYTES = 20
WORD = r"[^\x20\x09-\x0D]+"

ROOT = b""
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, up binary"
)


def turn_hex(role: Column, text: Column) -> Column:
    """The id of a turn in hexadecimal; role and text are told apart by the role's length."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    mark = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    words = F.regexp_count(text, F.lit(WORD))
    return F.concat(F.substring(F.sha2(mark, 256), 1, 32), F.lpad(F.lower(F.hex(words)), 8, "0"))


def own_turns(conversations: DataFrame) -> DataFrame:
    """One row for each conversation: its turn ids in order of turn, null first, then of turn id."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), turn_hex(F.col("role"), F.col("text")).alias("id")).alias("at"),
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("at"))["id"].alias("turns"))


def rebuilt(conversations: DataFrame, family: int, most_shared: int) -> DataFrame:
    """conv_id and ``path``, the turn ids of the rebuilt conversation one after the other.

    A conversation c starts with the first h turns of conversation c - c % ``family`` and goes on with its own
    turns after its first h; h is crc32 of c in decimals modulo ``most_shared`` + 1.
    """
    own = materialise(own_turns(conversations), "own_turns")
    c = F.col("conv_id")
    first = own.where(c % family == 0).select(c.alias("__donor"), F.slice("turns", 1, max(most_shared, 1)).alias("__first"))
    shared = (F.crc32(c.cast("string")) % (most_shared + 1)).cast("int")
    given = F.when(shared > 0, F.slice(F.coalesce("__first", F.array().cast("array<string>")), 1, F.greatest(shared, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    rest = F.slice("turns", shared + 1, F.greatest(F.size("turns"), F.lit(1)))
    joined = own.join(first, c - c % family == F.col("__donor"), "left")
    return joined.select("conv_id", F.unhex(F.array_join(F.concat(given, rest), "")).alias("path"))


def _prefix(depth: Column) -> Column:
    """The name of the node at a depth of a path."""
    return F.substring(F.unhex(F.sha2(F.substring("path", F.lit(1), depth * TURN_BYTES), 256)), 1, 16)


@dataclass
class _Node:
    depth: int
    words: int
    least: int | None = None
    convs: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: hashlib._Hash | None = None
    up: _Node | None = field(default=None, repr=False)

    def end(self, conv: int) -> None:
        if self.ends is None:
            self.ends = hashlib.sha256(b"%d" % conv)
        else:
            self.ends.update(b",%d" % conv)
        self.convs += 1
        self.least = conv if self.least is None else min(self.least, conv)

    def close(self) -> None:
        """Add up this node, whose children are closed, and hand its sums on."""
        self.leaves = self.leaves or 1
        self.saved += (self.convs - 1) * self.words
        if self.up:
            self.up.children += 1
            self.up.leaves += self.leaves
            self.up.saved += self.saved
            self.up.convs += self.convs
            self.up.least = self.least if self.up.least is None else min(self.up.least, self.least)


def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers from their suffixes in sorted order (box, depth, up, up_conv, conv_id, suffix).

    A stack holds the nodes on the path of the last suffix. What the next one does not share is closed; its
    own turns open new nodes. A container is bounded, and so are its nodes, which are given out at its end.
    """
    none = hashlib.sha256(b"").hexdigest()
    box, top, up, last = None, None, None, b""
    stack: list[_Node] = []
    nodes: list[_Node] = []
    out: list[tuple] = []

    def finish() -> None:
        while stack:
            stack.pop().close()
        for n in nodes:
            parent, above = (n.up.least, None) if n.up else (top, up)
            ends = n.ends.hexdigest() if n.ends else none
            out.append((n.least, n.depth, parent, n.convs, n.children, n.leaves, n.saved, ends, above))
        nodes.clear()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        names = [f.split()[0] for f in NODE.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        for row_box, depth, row_up, up_conv, conv, suffix in zip(*(c.to_pylist() for c in batch.columns)):
            if row_box != box:
                finish()
                box, top, up, last = row_box, up_conv, row_up, b""
            if suffix != last:
                shared, most = 0, min(len(suffix), len(last))
                while shared < most and suffix[shared : shared + TURN_BYTES] == last[shared : shared + TURN_BYTES]:
                    shared += TURN_BYTES
                while len(stack) > shared // TURN_BYTES:
                    stack.pop().close()
                for at in range(shared, len(suffix), TURN_BYTES):
                    words = int.from_bytes(suffix[at + 16 : at + TURN_BYTES], "big")
                    node = _Node(depth + at // TURN_BYTES, words, up=stack[-1] if stack else None)
                    stack.append(node)
                    nodes.append(node)
                last = suffix
            stack[-1].end(conv)
        if out:
            yield batch_of(out)
            out.clear()
    finish()
    if out:
        yield batch_of(out)


def _ends_of_heads(ended: DataFrame) -> DataFrame:
    """head and ``ends_sha256`` of the ids (conv_id) that end at each head, in ascending order.

    Ids are sorted over all tasks and joined into texts of ``ENDS_RUN`` ids; only those texts meet, and are hashed one
    after the other as they come, never held together.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(head: bytes, ids: list[int]) -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_arrays([pa.array([head], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([text])], names=["head", "first", "ids"])

        at, held = None, []
        for batch in batches:
            for head, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if head != at or len(held) == ENDS_RUN:
                    if held:
                        yield one(at, held)
                    at, held = head, []
                held.append(conv)
        if held:
            yield one(at, held)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(head: bytes, digest: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([head], pa.binary()), pa.array([digest])], names=["head", "ends"])

        at, running = None, None
        for batch in batches:
            for head, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if head != at:
                    if running:
                        yield one(at, running.hexdigest())
                    at, running = head, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
        if running:
            yield one(at, running.hexdigest())

    joined = ended.select("head", "conv_id").repartitionByRange("head", "conv_id").sortWithinPartitions("head", "conv_id")
    runs = joined.mapInArrow(texts, "head binary, first long, ids string")
    return runs.repartition("head").sortWithinPartitions("head", "first").mapInArrow(hashes, "head binary, ends string")


def _burst(paths: DataFrame, container_turns: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Heads of the trie, suffixes in containers, and conversations that end at a head.

    The root is a head and its suffixes are dealt by first turn. While containers are oversized they
    burst: their suffixes go by next turn ids into containers further down, one level in the first round and
    twice as many in each following one, so a long run of shared turns takes few rounds.
    """
    turns = (F.octet_length("path") / TURN_BYTES).cast("long")
    root = paths.agg(F.count("*").alias("convs"), F.min("conv_id").alias("conv_id"))
    root = root.select(F.lit(ROOT).alias("head"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), "convs", "conv_id")
    heads = [materialise(root.where("convs > 0"), "trie_heads")]
    sized = paths.withColumns({"n": turns, "base": F.lit(0).cast("long"), "up": F.lit(ROOT)})
    sized = sized.crossJoin(F.broadcast(heads[0].select(F.col("conv_id").alias("up_conv"))))  # one row
    boxed, ended = [], [sized.where("n = 0").select(F.col("up").alias("head"), "conv_id")]
    open_, levels, left = sized.where("n > 0"), 1, True
    while left:
        reach = F.least("n", F.col("base") + levels)
        below = open_.withColumn("depth", F.explode(F.sequence(F.col("base") + 1, reach)))
        below = below.select("conv_id", "n", "depth", _prefix(F.col("depth")).alias("head"), _prefix(F.col("depth") - 1).alias("above"),
                             F.conv(F.hex(F.substring("path", F.col("depth") * TURN_BYTES - 3, F.lit(4))), 16, 10).cast("long").alias("words"))
        above = F.when(F.col("depth") > 1, F.col("above")).otherwise(F.lit(ROOT))
        sizes = below.groupBy("head", above.alias("up"), "depth", "words").agg(
            F.count("*").alias("convs"), F.min("conv_id").alias("conv_id"), F.sum(F.col("n") - F.col("depth") + 1).alias("turns")
        )
        oversized = materialise(sizes.where(F.col("turns") > container_turns).drop("turns"), "trie_heads")
        heads.append(oversized)
        names = oversized.select("head", F.col("conv_id").alias("head_conv"))
        deepest = below.select("conv_id", "depth", "head").join(names, "head").groupBy("conv_id").agg(F.max(F.struct("depth", "head", "head_conv")).alias("to"))
        moved = materialise(
            open_.join(deepest, "conv_id", "left").select(
                "conv_id", "path", "n", (F.col("base") + levels).alias("counted"),
                F.coalesce("to.depth", "base").alias("base"), F.coalesce("to.head", "up").alias("up"), F.coalesce("to.head_conv", "up_conv").alias("up_conv"),
            ),
            "trie_suffixes",
        )
        ended.append(moved.where("base = n").select(F.col("up").alias("head"), "conv_id"))
        boxed.append(moved.where("base < n and base < counted"))
        open_ = moved.where("base < n and base = counted").drop("counted")
        left, levels = not open_.isEmpty(), levels * 2
    return _all(heads), _all(boxed), _all(ended)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _sum_up(heads: DataFrame) -> DataFrame:
    """Add the ``leaves`` and ``saved`` of all heads below to each head.

    A round adds the sums of the heads a jump below, which reach one jump far, and doubles the jump.
    """
    sums = heads.withColumn("jump", F.col("up"))
    for _ in range(int(heads.agg(F.max("depth")).first()[0] or 0).bit_length()):
        given = sums.where("jump is not null").groupBy(F.col("jump").alias("head"))
        given = given.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        next_jump = sums.select(F.col("head").alias("jump"), F.col("jump").alias("next"))
        sums = sums.join(given, "head", "left").join(next_jump, "jump", "left")
        sums = sums.withColumns({
            "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
            "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
            "jump": F.col("next"),
        }).drop("next", "more_leaves", "more_saved")
        sums = materialise(sums, "trie_sums")
    return sums


def prefix_trie(conversations: DataFrame, family: int = 20, most_shared: int = 3, container_turns: int = CONTAINER_TURNS) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations, the root included.

    ``conversations`` holds conv_id, turn, role and text; other columns are ignored. Turns are ordered by turn, null first,
    and where they share a turn by a digest of role and text. Null roles and texts are empty; rows without a conv_id take no part. A
    conversation is rebuilt as in ``rebuilt``. Each distinct sequence of first d turns is a node, and the conversations that
    start with it, also those without turns, are its members. An empty table has no nodes.

    Returns, per node, conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null at the root), n_convs,
    n_children, n_leaves (childless nodes in the subtree, itself included), saved_tokens (over the subtree, (n_convs - 1) times the
    words of the last text) and ends_sha256 (SHA-256 of the ascending ids of the members with d turns, joined by commas). A
    node is one row, named by conv_id and depth.

    Turns are identified by 16 bytes of a SHA-256, so texts are not shuffled. A conversation is one row of 20 bytes a turn. No group beyond
    that meets in one task unless it is bounded: a container holds at most ``container_turns`` turns (or one longer
    conversation, burst until its rest fits), and trie heads are counted by pre-aggregated sums.
    """
    bounded_batches(conversations.sparkSession)
    paths = materialise(rebuilt(conversations, family, most_shared), "trie_paths")
    heads, boxed, ended = _burst(paths, container_turns)

    depth = F.col("base") + 1
    suffix = F.substring("path", F.col("base") * TURN_BYTES + 1, F.octet_length("path"))
    containers = boxed.select(_prefix(depth).alias("box"), depth.alias("depth"), "up", "up_conv", "conv_id", suffix.alias("suffix"))
    swept = materialise(containers.repartition("box").sortWithinPartitions("box", "suffix", "conv_id").mapInArrow(sweep, NODE), "trie_nodes")

    tops = swept.where("up is not null").groupBy(F.col("up").alias("head"))
    tops = tops.agg(F.count("*").alias("boxes"), F.sum("n_leaves").alias("box_leaves"), F.sum("saved_tokens").alias("box_saved"))
    below = heads.where("up is not null").groupBy(F.col("up").alias("head")).agg(F.count("*").alias("heads"))
    own = heads.join(tops, "head", "left").join(below, "head", "left")
    zero = F.lit(0).cast("long")
    own = own.withColumn("children", F.coalesce("boxes", zero) + F.coalesce("heads", zero))
    own = own.withColumns({
        "leaves": F.when(F.col("children") == 0, F.lit(1)).otherwise(F.coalesce("box_leaves", zero)).cast("long"),
        "saved": (F.col("convs") - 1) * F.col("words") + F.coalesce("box_saved", zero),
    }).drop("boxes", "heads", "box_leaves", "box_saved")
    sums = _sum_up(materialise(own, "trie_sums"))
    parents = heads.select(F.col("head").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    named = sums.join(parents, "up", "left").join(_ends_of_heads(ended), "head", "left")
    of_heads = named.select(
        "conv_id", "depth", "parent_conv_id", F.col("convs").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    return swept.drop("up").unionByName(of_heads)
