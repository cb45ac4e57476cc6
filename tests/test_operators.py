"""Operators against small hand-written cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedweave.functions.privacy import KeyRing
from feedweave.operators import lookups, state
from feedweave.operators.dedupe import dedupe_keys
from feedweave.operators.filters import current_rows, drop_null_tokens
from feedweave.operators.layout import Field, Layout, record_length
from feedweave.operators.quality import gate
from feedweave.operators.totals import total_per_group

RING = KeyRing({"1": "00" * 16, "2": "11" * 16})


@pytest.mark.parametrize(
    "terms", [["ring"], ["a", "bolt x", "g"], [], ["", None], [" ring", "ring ", " "], [f"t{k}x" for k in range(3000)]]
)
def test_terms_match_brute_force(spark, terms):
    names = ["a ring", "bolt", "bolt xy", "", None, "RING", "ring", "zig", "t1x", "at2999xb", "long t7 " * 400]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    listed = spark.createDataFrame([(t,) for t in terms], "term string")
    kept = [r.name for r in lookups.exclude_terms(df, "name", listed, "term").collect()]
    wanted = [n for n in names if not n or not any(t in n for t in terms if t)]
    assert sorted(kept, key=str) == sorted(wanted, key=str)


def test_flag_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    lookup = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    rows = lookups.flag_if_in(df, lookup, {"k": "id"}, "hit").collect()
    assert sorted((r.v, r.hit) for r in rows) == [("a", "Y"), ("b", "N"), ("c", "N")]
    assert lookups.exclude_if_in(df, lookup, {"k": "id"}).count() == 2


def test_total_per_group_with_null_keys(spark):
    rows = [("a", 1, "x", 2), ("a", 1, "y", 3), ("a", 1, "y", 4), (None, 1, "x", 5), (None, 1, "z", 6)]
    df = spark.createDataFrame(rows, "k string, p int, rest string, qty int")
    got = sorted((r.k or "", r.rest, r.total) for r in total_per_group(df, ["k", "p"], "qty", "total").collect())
    assert got == [("", "x", 11), ("", "z", 11), ("a", "x", 9), ("a", "y", 9)]


def test_dedupe_is_deterministic(spark):
    rows = [(1, 5, None), (1, 5, "b"), (1, 5, "a"), (2, None, "z")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, p int, s string").repartition(3)
        assert sorted(tuple(r) for r in dedupe_keys(df, ["k"]).collect()) == [(1, 5, "a"), (2, None, "z")]


def test_current_rows_by_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, date'9999-12-31', timestamp'9999-12-31 00:00:00', '9999-12-31 00:00:00'), "
        "(2, date'2020-01-01', timestamp'2020-01-01 10:00:00', '2020-01-01') AS v(id, d, t, s)"
    )
    assert [r.id for r in current_rows(df, "d").collect()] == [1]
    assert [r.id for r in current_rows(df, "t").collect()] == [1]
    assert [r.id for r in current_rows(df, "s", text_prefix=True).collect()] == [1]
    assert current_rows(df, "s").count() == 0


def test_null_tokens(spark):
    df = spark.createDataFrame([("null",), (None,), ("",), ('""',), ("a@b",)], "EMAIL string")
    assert [r.EMAIL for r in drop_null_tokens(df, "EMAIL").collect()] == ["a@b"]


def test_record_rejects_short_long_and_overflow(spark):
    layout = Layout(
        (
            Field("n", 2, ("a",), lambda ctx, w, c: c, strict=True),
            Field("t", 2, ("b",), lambda ctx, w, c: c),
        )
    )
    df = spark.createDataFrame([("12", "ab"), ("123", "a"), (None, "ab"), ("1", "é"), ("12", "é")], "a string, b string")
    rows = {r.fixedlength: (r.encode, r.layout_ok) for r in layout.record(df).collect()}
    assert rows == {"12ab": (4, True), "123a": (4, False), "ab": (2, False), "1é": (3, False), "12é": (4, True)}
    assert layout.positions == {"n": (1, 2), "t": (3, 2)}


def test_record_length_counts_bytes(spark):
    assert spark.createDataFrame([("é  ",)], "c string").select(record_length(F.col("c"))).first()[0] == 4


def test_gate_decisions(spark):
    df = spark.createDataFrame([("a", 0, 0), ("b", 10, 0), ("c", 10, 1), ("d", 10, 5)], "f string, formatted int, rejected int")
    got = {r.f: (r.reject_pct, r.decision) for r in gate(df, "rejected", "formatted", 20.0).collect()}
    assert got == {"a": (None, "empty"), "b": (0.0, "clean"), "c": (10.0, "with_rejects"), "d": (50.0, "stop")}


def test_protection(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("x" * 200,)], "c string")
    token = RING.protect(F.col("c"), "1")
    rows = df.select(
        "c", token.alias("t"), RING.unprotect(token, "1").alias("back"),
        RING.unprotect(RING.reprotect(token, "1", "2"), "2").alias("swapped"),
        RING.unprotect(F.lit("bm8gdG9rZW4="), "1").alias("junk"),
    ).collect()
    assert all(r.back == r.c and r.swapped == r.c and r.junk is None for r in rows)
    assert len({r.t for r in rows if r.c == "a"}) == 1 and len({r.t for r in rows}) == 4
    assert all("\n" not in (r.t or "") for r in rows)
    assert "00" * 16 not in repr(RING)


def test_state_versions(spark, tmp_path):
    root = str(tmp_path / "state")
    first = spark.createDataFrame([("x", "/a", "N", 1), ("x", "/b", "N", 2)], "extract_name string, extract_landing_path string, flag string, n long")
    assert state.write_state(spark, first, root) == 1
    changes = spark.createDataFrame([("x", "/a", "Y", None), ("x", "/zz", "Y", 5)], "extract_name string, extract_landing_path string, flag string, n int")
    assert state.write_state(spark, state.apply_state(state.read_state(spark, root), changes, where=F.lit(True)), root) == 2
    # a version that was never committed is not seen
    first.write.parquet(f"{root}/version=3")
    rows = sorted(tuple(r) for r in state.read_state(spark, root).collect())
    assert rows == [("x", "/a", "Y", 1), ("x", "/b", "N", 2)]
    with pytest.raises(ValueError):
        state.read_state(spark, str(tmp_path / "none"))


def test_override_does_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    side = spark.createDataFrame([(1, "y"), (1, "x"), (1, None), (2, None), (None, "z")], "id int, w string")
    got = sorted((r.k or 0, r.v) for r in lookups.attach_override(df, side, {"k": "id"}, "w", "v").collect())
    assert got == [(0, "c"), (1, "x"), (2, "b")]


def test_huge_numbers_stay_whole(spark):
    from feedweave.functions import numbers

    digits = ["1" * 20, "9" * 40, "12", "x" * 40, None]
    df = spark.createDataFrame([(d,) for d in digits], "c string")
    keys = [r[0] for r in df.select(numbers.offset_key(F.col("c"), 1, 15, "left", "0")).collect()]
    assert keys == [str(int("1" * 20) + 1), "9" * 40, "13".rjust(15, "0"), None, None]
    ids = [r[0] for r in df.select(numbers.hex_id(F.col("c"), 11)).collect()]
    assert ids[:3] == ["1" * 20, "9" * 40, "C".ljust(11)]


def test_missing_field_does_not_make_up_for_a_wide_one(spark):
    from feedweave.plans.claim_layout import CLAIM_LAYOUT

    bare = Layout((Field("a", 1, ("a",), lambda ctx, w, c: c, strict=True), Field("b", 1, ("b",), lambda ctx, w, c: c, strict=True)))
    rows = bare.record(spark.createDataFrame([("x", "y"), (None, "XY")], "a string, b string")).collect()
    assert [r.layout_ok for r in rows] == [True, False]
    unpadded = {"prescription_type_60149", "partial_fill_cd", "daw_prod_selection_cd_408d8", "prescription_origin_code", "free_goods"}
    numbers = {"rx_fill_nbr", "days_supply_405d5", "reject_count_510fa", "original_store_id", "current_store_id_7"}
    assert all(f.strict for f in CLAIM_LAYOUT.fields if f.name in unpadded | numbers)


def _pending(spark, *paths, **flags):
    made = [("e", p, *(state.PENDING_FLAGS | flags).values(), 5, None) for p in paths]
    names = ", ".join(f"{f} string" for f in state.PENDING_FLAGS)
    return spark.createDataFrame(made, f"extract_name string, extract_landing_path string, {names}, master_straight_record_count int, n long")


def test_state_changes_meet_the_newest_version(spark, tmp_path):
    root = str(tmp_path / "s")
    state.write_state(spark, _pending(spark, "/p1"), root)
    changes = spark.createDataFrame([("e", "/p1", 7)], "extract_name string, extract_landing_path string, n long")
    # a landing recorded meanwhile
    state.write_state(spark, state.read_state(spark, root).union(_pending(spark, "/p2")), root)
    assert state.commit_changes(spark, changes, root) == 3
    assert {(r.extract_landing_path, r.n) for r in state.read_state(spark, root).collect()} == {("/p1", 7), ("/p2", None)}


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    state.write_state(spark, _pending(spark, "/p1"), root)
    real, overtaken = state._commit, []

    def slow(spark_, new, root_, version):
        if not overtaken:
            overtaken.append(version)
            real(spark_, state.read_state(spark_, root_).union(_pending(spark_, "/p2")), root_, version)
        return real(spark_, new, root_, version)

    monkeypatch.setattr(state, "_commit", slow)
    changes = spark.createDataFrame([("e", "/p1", 7)], "extract_name string, extract_landing_path string, n long")
    assert state.commit_changes(spark, changes, root) == 3
    assert {(r.extract_landing_path, r.n) for r in state.read_state(spark, root).collect()} == {("/p1", 7), ("/p2", None)}


def test_processed_rows_and_unknown_columns(spark):
    table = _pending(spark, "/p").union(_pending(spark, "/p", transformation_complition_flag="Y"))
    changes = spark.createDataFrame([("e", "/p", 7)], "extract_name string, extract_landing_path string, n long")
    got = {(r.transformation_complition_flag, r.n) for r in state.apply_state(table, changes).collect()}
    assert got == {("N", 7), ("Y", None)}
    with pytest.raises(ValueError, match="no column m"):
        state.apply_state(table, changes.withColumnRenamed("n", "m"))


def test_old_versions_of_the_state_are_deleted(spark, tmp_path):
    root = str(tmp_path / "state")
    for k in range(state.KEPT_VERSIONS + 3):
        assert state.write_state(spark, spark.createDataFrame([(k,)], "v int").coalesce(1), root) == k + 1
    assert len(list((tmp_path / "state").glob("version=*"))) == state.KEPT_VERSIONS
    assert state.read_state(spark, root).first().v == state.KEPT_VERSIONS + 2
    assert state.read_state(spark, root, 4).first().v == 3
