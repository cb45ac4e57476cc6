import hashlib
import random
import re
import zlib

import pytest

from feedweave.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_id(role, text):
    mark = f"{len(role.encode())}:{role}{text}"
    return hashlib.sha256(mark.encode()).hexdigest()[:32]


def brute_force(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, turn_id(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    out = []
    for prefix, convs in members.items():
        subtree = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in subtree if len(p) == len(prefix) + 1]
        leaves = [p for p in subtree if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in subtree if p)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(paths[c]) == len(prefix)))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append((min(convs), len(prefix), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    r = random.Random(seed)
    rows = []
    for c in range(60):
        for t in range(r.randrange(1, 7)):
            turn = None if r.random() < 0.05 else t
            rows.append((c, turn, r.choice(["user", "assistant", None]), r.choice(["", "a", "a b", "a\tb  c", "ü x", None])))
    rows += [(200 + k, t, "user", "same turn") for k in range(25) for t in range(9)]
    rows += [(3, 1, "user", "again"), (3, 1, "user", "again"), (None, 0, "user", "lost"), (999, 0, "user", "alone")]
    return rows


@pytest.mark.parametrize("container_turns", [1, 6, 40, 2048])
def test_nodes_equal_brute_force(spark, rows_of, container_turns):
    rows = made(container_turns)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS up", "1 AS depth", "2 AS head")
    assert rows_of(prefixtrie.prefix_trie(df, container_turns=container_turns), *COLUMNS) == brute_force(rows)


def test_long_chain_takes_few_rounds(spark, rows_of, monkeypatch):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2, 3) for t in range(120)]
    written = []
    real = prefixtrie.materialise
    monkeypatch.setattr(prefixtrie, "materialise", lambda df, label: written.append(label) or real(df, label))
    assert rows_of(prefixtrie.prefix_trie(spark.createDataFrame(rows, SCHEMA), container_turns=5), *COLUMNS) == brute_force(rows)
    assert written.count("trie_suffixes") <= 8  # spans of 1, 2, 4, ... levels


def test_many_ids_end_at_a_head(spark, rows_of, monkeypatch):
    monkeypatch.setattr(prefixtrie, "ENDS_RUN", 7)
    rows = [(20 * c, 0, "user", "hello there") for c in range(90)]
    assert rows_of(prefixtrie.prefix_trie(spark.createDataFrame(rows, SCHEMA), container_turns=10), *COLUMNS) == brute_force(rows)


def test_conversations_without_turns_end_at_the_root(spark, rows_of):
    # the donors are absent and the first turns are given away
    rows = [(c, 0, "user", "x") for c in range(1, 20)]
    found = brute_force(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in found)
    assert rows_of(prefixtrie.prefix_trie(spark.createDataFrame(rows, SCHEMA)), *COLUMNS) == found


def test_empty_table_and_no_usable_rows(spark):
    assert prefixtrie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefixtrie.prefix_trie(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)).count() == 0
