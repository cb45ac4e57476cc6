import pytest
from pyspark.sql import functions as F

from feedweave.llm import catalog, mixing

SCHEMA = "doc_id long, text string, source string"


def documents(supply, start=0):
    rows, k = [], start
    for source, n in supply.items():
        for _ in range(n):
            rows.append((k, f"text {k}", source))
            k += 1
    return rows


def check_windows(slots, supply, weights, size):
    """Each pool is less than one block from its ideal at every slot, also after pools run out."""
    blocks = {p: -(-n // size) for p, n in supply.items()}
    got = dict.fromkeys(blocks, 0)
    ideal = dict.fromkeys(blocks, 0.0)
    for pool in slots:
        left = 1.0
        while left > 1e-12:  # one slot of time, shared by the live pools
            live = [p for p in blocks if ideal[p] < blocks[p] - 1e-9]
            total = sum(weights[p] for p in live)
            step = min([left, *[(blocks[p] - ideal[p]) * total / weights[p] for p in live]])
            for p in live:
                ideal[p] += step * weights[p] / total
            left -= step
        got[pool] += 1
        assert all(abs(got[p] - ideal[p]) < 1 + 1e-6 for p in blocks), (got, ideal)
    assert got == blocks


@pytest.mark.parametrize(
    "supply, weights, blocks",
    [
        ({"a": 50, "b": 30, "c": 20}, {"a": 5, "b": 3, "c": 2}, 4096),
        ({"a": 400, "b": 30, "c": 7, "d": 90}, {"a": 1, "b": 30, "c": 11, "d": 3}, 100),
        ({"a": 333, "b": 333, "c": 334}, {"a": 97, "b": 2, "c": 1}, 64),
        ({"a": 1, "b": 1}, {"a": 1, "b": 1}, 1),
    ],
)
def test_less_than_one_block_from_ideal(spark, supply, weights, blocks):
    docs = spark.createDataFrame(documents(supply), SCHEMA)
    rows = mixing.mix(docs, weights, blocks=blocks).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(sum(supply.values())))
    assert len({r["doc_id"] for r in rows}) == len(rows)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    slots = [p for _, p in sorted({(r["slot"], r["pool"]) for r in rows})]
    check_windows(slots, supply, weights, max(1, -(-len(rows) // blocks)))


def test_odd_rows(spark):
    rows = [*documents({"a": 5, None: 3, "": 2, "zz": 4}), (None, None, "a"), (None, "", "a"), (0, "again", "a"), (1, "text 1", "a"), (1, "text 1", "a")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"position": F.lit("mine"), "Slot": F.lit(1)})
    mixed = mixing.mix(docs, {"a": 3, "none of this": 9}, other_weight=2)
    assert sorted(mixed.columns) == sorted(["doc_id", "text", "source", "pool", "block", "slot", "release", "deadline", "position"])
    found = mixed.collect()
    assert sorted(r["position"] for r in found) == list(range(len(rows)))
    assert {(r["source"], r["pool"]) for r in found} == {("a", "a"), (None, None), ("", None), ("zz", None)}
    ordered = mixing.in_mixed_order(docs, {"a": 3}, other_weight=2)
    assert ordered.columns == docs.columns and ordered.count() == len(rows)
    assert {r["position"] for r in ordered.collect()} == {"mine"}
    assert mixing.mix(docs.where("false"), {"a": 3}).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, {"a": 0})


def test_written_order_is_the_mix(spark, tmp_path):
    docs = spark.createDataFrame(documents({"a": 60, "b": 30, "c": 30}), SCHEMA)
    weights = {"a": 2, "b": 1, "c": 1}
    order = [r["doc_id"] for r in mixing.in_mixed_order(docs, weights).collect()]
    assert order == [r["doc_id"] for r in mixing.mix(docs, weights).orderBy("position").collect()]


def test_main_path_is_native(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame(documents({"src0": 20, "src5": 9, "else": 3}), SCHEMA).write.parquet(f"{folder}/documents.parquet")
    plan = catalog.op9_mixing(spark, folder)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_hot_source_spreads(spark):
    """Two thirds of the rows in one source: no window holds more than a small share of them."""
    docs = spark.range(20000).selectExpr("id AS doc_id", "'' AS text", "IF(id % 3 < 2, 'hot', 'cold') AS source")
    from feedweave.llm.common import number_in_group, slice_key

    slices = docs.groupBy("source", slice_key(F.col("doc_id"))).count().agg(F.max("count")).first()[0]
    assert slices < 30
    numbered = number_in_group(docs, "source", "doc_id", [], "n")
    top = {r["source"]: (r["m"], r["c"]) for r in numbered.groupBy("source").agg(F.max("n").alias("m"), F.countDistinct("n").alias("c")).collect()}
    assert top == {"hot": (13333, 13334), "cold": (6665, 6666)}
