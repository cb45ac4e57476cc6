"""The feeds end to end, through files."""

import datetime as dt
import pathlib
from dataclasses import replace

from pyspark.sql import functions as F

from feedweave.catalog import QUERIES, feeds, shapes
from feedweave.catalog.registry import Tables
from feedweave.functions import fixed_values as fixed
from feedweave.functions.privacy import KeyRing
from feedweave.operators import state
from feedweave.plans import claim_layout, contact_feed, fixed_extract, purchase_feed
from feedweave.sources import publishing, readers, writers

FOLDER = "/root/testdata/sf0.001"
SEP = fixed.FIELD_SEPARATOR


def lines(path):
    return sorted(
        line for part in sorted(path.rglob("part-*")) if not part.name.endswith(".crc")
        for line in part.read_text().splitlines()
    )


def parts_of(spark, out, part):
    """All lines of one part of the published extracts."""
    paths = publishing.published(spark, str(out), part, "extract")
    return sorted(x for p in paths for x in lines(type(out)(p)))


def test_layout_is_the_agreed_record():
    layout = claim_layout.CLAIM_LAYOUT
    assert layout.width == fixed.RECORD_WIDTH and len(layout.fields) == 101 and len(layout.source_columns) == 85
    assert len({f.name for f in layout.fields}) == 101
    assert layout.positions["current_store_id_7"] == (702, 7)


def write_claims(claims, folder):
    """One file per extract, with a header, as the landing area holds them."""
    columns = [c for c in shapes.CLAIM_COLUMNS if c != "extract_file"]
    paths = []
    for (name,) in claims.select("extract_file").distinct().collect():
        rows = claims.filter(F.col("extract_file") == name).select(*columns)
        path = folder / name.rsplit("/", 1)[1]
        body = [SEP.join("" if v is None else v for v in r) for r in rows.collect()]
        path.write_text("\n".join([SEP.join(columns), *body]) + "\n")
        paths.append(str(path))
    return sorted(paths)


def test_fixed_extract_run(spark, tmp_path):
    t = Tables(spark, FOLDER)
    ring = KeyRing({k: "0f" * 16 for k in set(claim_layout.PROTECTED.values())})
    cfg = fixed_extract.Settings(
        30.0, feeds.AS_OF, claim_layout.VARIANT_2, frozenset(claim_layout.PROTECTED), ring
    )
    landing = tmp_path / "landing"
    landing.mkdir()
    claims = feeds.protected_claims(t, ring)
    paths = write_claims(claims, landing)
    empty = landing / "empty.dat"
    empty.write_text(SEP.join(c for c in shapes.CLAIM_COLUMNS if c != "extract_file") + "\n")
    flags = {"extract_landing_flag": "Y", "extract_prcsd_flag": "N", "transformation_complition_flag": "N",
             "deid_complition_flag": "N", "transformed_file_deletion_flag": "N"}
    columns = ["extract_name", "extract_landing_path", *flags, "master_straight_record_count"]
    rows = [("master_transactions", p, *flags.values(), 9) for p in [*paths, str(empty)]]
    rows.append(("master_transactions", "/never/landed.dat", "N", *list(flags.values())[1:], 9))
    table = spark.createDataFrame(rows, columns).withColumns({
        "drugExclusion_record_count": F.lit(None).cast("long"), "plan_exclusion_record_count": F.lit(None).cast("long"),
        "layout_reject_record_count": F.lit(None).cast("long"), "transformed_file_landing_path": F.lit(None).cast("string"),
        "transformation_complition_dttm": F.lit(None).cast("timestamp"), "last_update_dttm": F.lit(None).cast("timestamp"),
    })
    root, out = str(tmp_path / "state"), tmp_path / "out"
    state.write_state(spark, table, root)
    verdicts = fixed_extract.run(spark, root, feeds.claim_lookups(t), str(out), cfg)
    by_file = {r.extract_file: r for r in verdicts.collect()}
    assert set(by_file) == {*paths, str(empty)} and by_file[str(empty)].decision == "empty"

    # text files turn '' into null, so compare with the same claims after that change
    blanked = claims.select(*[F.when(F.col(c) == "", None).otherwise(F.col(c)).alias(c) for c in claims.columns])
    expected = fixed_extract.classify(blanked, feeds.claim_lookups(t), cfg).collect()
    open_files = {f.rsplit("/", 1)[1] for f, r in by_file.items() if r.decision in ("clean", "with_rejects")}
    assert open_files
    valid = sorted(r.fixedlength for r in expected if r.status == "valid" and r.extract_file.rsplit("/", 1)[1] in open_files)
    rejects = [r for r in expected if r.status == "reject" and r.extract_file.rsplit("/", 1)[1] in open_files]
    assert parts_of(spark, out, "valid") == valid and all(len(x.encode()) == 708 for x in valid)
    back = readers.read_delimited(spark, publishing.published(spark, str(out), "rejects", "extract"), sep=",").collect()
    assert sorted(r.fixedlength for r in back) == sorted(r.fixedlength for r in rejects)
    for r in by_file.values():
        assert r.total == r.plan_excluded + r.term_excluded + r.valid + r.rejected + r.malformed and r.malformed == 0

    after = {r.extract_landing_path: r for r in state.read_state(spark, root).collect()}
    assert after["/never/landed.dat"].transformation_complition_flag == "N"
    for path, r in by_file.items():
        done = r.decision in ("clean", "with_rejects")
        assert after[path].transformation_complition_flag == ("Y" if done else "N")
        assert after[path].drugExclusion_record_count == r.term_excluded
        if done:
            folder = after[path].transformed_file_landing_path
            assert len(lines(tmp_path.__class__(folder))) == r.valid
    left = fixed_extract.run(spark, root, feeds.claim_lookups(t), str(tmp_path / "again"), replace(cfg, extract_name="other"))
    assert left is None


def test_masked_extract_shows_no_clear_text(spark):
    t = Tables(spark, FOLDER)
    cfg = replace(feeds.extract_settings(claim_layout.VARIANT_1), unmask=frozenset())
    ring = feeds.extract_settings(claim_layout.VARIANT_1).keys
    rows = fixed_extract.classify(feeds.protected_claims(t, ring), feeds.claim_lookups(t), cfg)
    record = F.col("fixedlength")
    at, width = claim_layout.CLAIM_LAYOUT.positions["first_name_encrypted"]
    shown = rows.filter(record.isNotNull())
    assert shown.filter(F.substring(record, at, width).contains("Customer")).count() == 0
    assert shown.filter(F.col("status") == "valid").count() > 0


def test_contact_feed_run(spark, tmp_path):
    ring = KeyRing({"8000": "aa" * 16, "1": "bb" * 16})
    header = SEP.join(fixed.CONTACT_COLUMNS)

    def token(mail):
        df = spark.createDataFrame([(mail,)], "c string")
        return df.select(ring.protect(F.col("c"), "8000")).first()[0]

    def row(i, mail):
        values = [str(i), "P", 'Ann "A"', "Lee", "1990-01-01", "EMAIL", mail, "", "Site", "1", "EN"]
        return SEP.join(values)

    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "x_ConsentA_1.dat").write_text("\n".join([header, row(1, token("a@b")), row(2, ""), row(3, "null"), row(4, '""')]) + "\n")
    (inbox / "x_ConsentB_1.dat").write_text(header + "\n" + row(5, token("c@d")) + "\n")
    (inbox / "x_ConsentB_2.dat").write_text(header + "\n" + row(6, token("e@f")) + "\n")
    (inbox / "x_ConsentA_1.txt").write_text(header + "\n")
    cfg = contact_feed.Settings(keys=ring, tags=("ConsentA", "ConsentB", "ConsentC"))
    result = contact_feed.run(spark, str(inbox), str(tmp_path / "out"), cfg)
    status = {r.cohort: r.status for r in result.status.collect()}
    assert status == {"ConsentA": "ok", "ConsentB": "multiple", "ConsentC": "missing"}
    assert result.manifest["rows"] == 1 and result.check.first().ok and result.published == ["ConsentA"]
    back = readers.read_delimited(spark, publishing.published(spark, str(tmp_path / "out"), "feed", "cohort"))
    (r,) = back.select("PATIENT_ID", "PATIENT_FIRST_NAME", ring.unprotect(F.col("EMAIL"), "1").alias("EMAIL")).collect()
    assert tuple(r) == ("1", 'Ann "A"', "a@b")
    none = contact_feed.run(spark, str(inbox), str(tmp_path / "none"), replace(cfg, tags=("ConsentC",)))
    assert none.manifest is None


def test_purchase_feed_run(spark, tmp_path):
    t = Tables(spark, FOLDER)
    cfg = feeds.purchase_settings(keys=KeyRing({"1": "cc" * 16}))
    out = str(tmp_path / "feed")
    written = purchase_feed.run(spark, feeds.purchase_tables(t), cfg, out)
    clear = purchase_feed.build(feeds.purchase_tables(t), cfg)
    assert written["rows"] == clear.count() > 0
    assert written["rows_with_header"] == written["rows"] + 1
    (path,) = publishing.published(spark, out, "feed")
    back = readers.read_delimited(spark, path, sep="|")
    ids = back.select(cfg.keys.unprotect(F.unbase64("user_id").cast("string"), "1").alias("u")).distinct()
    assert sorted(r.u for r in ids.collect()) == sorted(r[0] for r in clear.select("user_id").distinct().collect())
    manifest = spark.read.json(path + "_manifest").first()
    assert manifest.rows == written["rows"] and int(manifest.checksum_2) == written["checksum_2"]
    assert writers.verify_written(spark, path, written, clear.columns).first().ok
    more = written | {"rows": written["rows"] + 1}
    assert writers.verify_written(spark, path, more, clear.columns).first().ok is False


def test_sales_without_valid_fields_leave(spark):
    good = (1100, "t1", "19960101", "s", "5", "a", "1", "2.0", 1.5, "")
    rows = [
        good,
        (1100, "t1", "19960101", "s", "5", "a", "1", "2", 1.5, ""),
        (1100, "t1", "19960101", "s", "5", "a", "2", "3", 1.5, ""),
        (1100, "t1", "19960101", "s", "5", "a", "3", "-1", 1.5, ""),
        (1100, "t1", "19960101", "s", "bad", "a", "4", "1", 1.5, ""),
        (1100, " ", "19960101", "s", "5", "a", "5", "1", 1.5, ""),
        (1100, "t1", "19960199", "s", "5", "a", "6", "1", 1.5, ""),
        (1100, "t1", "19970101", "s", "5", "a", "7", "1", 1.5, ""),
        (1000, "t1", "19960101", "s", None, None, None, None, None, "L1"),
        (1000, "t1", "19960101", "s", None, None, None, None, None, " "),
    ]
    schema = (
        "RECORDTYP int, RFN string, SALES_TXN_DT string, STORE_NBR string, UPC_NBR string, ARTICLE_NBR string, "
        "LINE_ITEM_SEQ_NBR string, UNIT_QTY string, ITEM_UNIT_PRICE_DLRS double, loyalty_id string"
    )
    cfg = purchase_feed.Settings(dt.date(1996, 1, 1), dt.date(1996, 12, 31))
    sales = purchase_feed.sales_in_window(spark.createDataFrame(rows, schema), cfg)
    totals = purchase_feed.item_totals(purchase_feed.loyalty_lines(sales)).collect()
    assert [(r.RFN, r.UPC_NBR, r.LOYALTY_ID, r.QTY) for r in totals] == [("t1", 5, "L1", 5)]


def test_lookup_and_cohort_sources(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_text('k,v\n a ,2\na,1\n,9\n"b",3\n')
    got = sorted(tuple(r) for r in readers.read_lookup(spark, str(path), ["k"]).collect())
    assert got == [("a", "1"), ("b", "3")]


def test_settings_for_run():
    cfg = purchase_feed.Settings.for_run(dt.date(2024, 3, 1))
    assert (cfg.first_day, cfg.last_day) == (dt.date(2024, 2, 29), dt.date(2024, 3, 1))


def _state_table(spark, paths):
    flags = state.PENDING_FLAGS
    columns = ["extract_name", "extract_landing_path", *flags, "master_straight_record_count"]
    table = spark.createDataFrame([("master_transactions", p, *flags.values(), 9) for p in paths], columns)
    counts = ["drugExclusion_record_count", "plan_exclusion_record_count", "layout_reject_record_count"]
    none = {c: F.lit(None).cast("long") for c in counts} | {"transformed_file_landing_path": F.lit(None).cast("string")}
    none |= {c: F.lit(None).cast("timestamp") for c in ("transformation_complition_dttm", "last_update_dttm")}
    return table.withColumns(none)


def test_files_with_other_headers_blanks_and_folders(spark, tmp_path):
    """Each file is read under its own header and found under its landing path."""
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "one%.dat").write_text(SEP.join("xyz") + "\n" + SEP.join("123") + "\n")
    (tmp_path / "a b" / "two.dat").write_text(SEP.join("yxzw") + "\n" + SEP.join("5647") + "\n")
    (tmp_path / "short.dat").write_text(SEP.join("xy") + "\n" + SEP.join("89") + "\n")
    (tmp_path / "empty.dat").write_text(SEP.join("zyx") + "\n")
    paths = [str(tmp_path / p) for p in ("a b", "short.dat", "empty.dat")]
    landed = readers.read_landed(spark, paths, ["x", "y", "z"], "file", "damaged")
    assert sorted(map(tuple, landed.rows.collect())) == [("1", "2", "3", None, paths[0]), ("6", "5", "4", None, paths[0])]
    assert landed.unreadable == {paths[1]: ["z"]}
    assert readers.read_landed(spark, paths[1:2], ["z"], "file", "damaged").rows is None


def test_second_run_leaves_other_extracts_alone(spark, tmp_path):
    t, out, root = Tables(spark, FOLDER), tmp_path / "out", str(tmp_path / "state")
    cfg = replace(feeds.extract_settings(claim_layout.VARIANT_2), reject_threshold=100.0)
    claims = feeds.protected_claims(t, cfg.keys)
    paths = write_claims(claims, tmp_path)
    state.write_state(spark, _state_table(spark, paths[:1]), root)
    fixed_extract.run(spark, root, feeds.claim_lookups(t), str(out), cfg)
    valid = lambda: {p.rsplit("/", 1)[1]: lines(tmp_path.__class__(p)) for p in publishing.published(spark, str(out), "valid", "extract")}
    before = valid()
    state.write_state(spark, state.read_state(spark, root).union(_state_table(spark, paths[1:2])), root)
    fixed_extract.run(spark, root, feeds.claim_lookups(t), str(out), cfg)
    after = valid()
    assert len(before) == 1 and len(after) == 2 and after.items() >= before.items()
    assert spark.read.parquet(*publishing.published(spark, str(out), "totals", "extract")).count() == 2
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not list(tmp_path.__class__(shared).glob("feedweave/claims-*")), "staged rows are deleted"


def test_staged_rows_are_deleted_on_failure(spark, tmp_path, monkeypatch):
    t, root = Tables(spark, FOLDER), str(tmp_path / "state")
    cfg = feeds.extract_settings(claim_layout.VARIANT_2)
    paths = write_claims(feeds.protected_claims(t, cfg.keys).limit(20), tmp_path)
    state.write_state(spark, _state_table(spark, paths), root)

    def broken(*_):
        raise RuntimeError("no space")

    monkeypatch.setattr(fixed_extract, "write_fixed_width", broken)
    try:
        fixed_extract.run(spark, root, feeds.claim_lookups(t), str(tmp_path / "out"), cfg)
    except RuntimeError:
        pass
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    assert not list(tmp_path.__class__(shared).glob("feedweave/claims-*"))
    assert {r.transformation_complition_flag for r in state.read_state(spark, root).collect()} == {"N"}


def test_the_extract_holds_the_landings_of_one_run_and_compressed_records(spark):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "feedweave"
    before = set(shared.glob("*"))
    found = QUERIES["fixed_extract_run"](spark, FOLDER)
    made = {p.name.split("-")[0]: p for p in set(shared.glob("*")) - before}
    assert sorted(p.name for p in made["landing"].iterdir()) == ["claims empty.dat", "claims short.dat", "state"]
    parts = [p for p in made["extracts"].rglob("part-*") if not p.match("*/totals/*/*")]
    assert parts and all(p.name.endswith(".gz") for p in parts)
    assert found.filter("kind = 'record valid'").count() > 1000


def test_lines_with_other_numbers_of_fields_are_quarantined(spark, tmp_path):
    t, out, root = Tables(spark, FOLDER), tmp_path / "out", str(tmp_path / "state")
    cfg = replace(feeds.extract_settings(claim_layout.VARIANT_2), reject_threshold=100.0)
    (path,) = write_claims(feeds.protected_claims(t, cfg.keys).filter("extract_file LIKE '%claims_1%'"), tmp_path)
    file = tmp_path.__class__(path)
    good = file.read_text().splitlines()
    bad = [SEP.join(["shifted", good[1]]), good[2].split(SEP, 3)[0], good[3].rsplit(SEP, 1)[0], '"open quote' + SEP + "x"]
    file.write_text("\n".join([good[0], bad[0], *good[1:], *bad[1:]]) + "\n")
    state.write_state(spark, _state_table(spark, [path]), root)
    (r,) = fixed_extract.run(spark, root, feeds.claim_lookups(t), str(out), cfg).collect()
    assert parts_of(spark, out, "malformed") == sorted(bad)
    assert (r.malformed, r.total) == (4, len(good) - 1 + 4) and r.decision == "with_rejects"
    assert len(parts_of(spark, out, "valid")) == r.valid
    (row,) = state.read_state(spark, root).collect()
    assert row.layout_reject_record_count == r.rejected + 4
    # many of them stop the extract
    file.write_text("\n".join([good[0], good[1], *bad]) + "\n")
    state.write_state(spark, _state_table(spark, [path]), root)
    (r,) = fixed_extract.run(spark, root, feeds.claim_lookups(t), str(out), replace(cfg, reject_threshold=50.0)).collect()
    assert r.decision == "stop" and parts_of(spark, out, "valid") == []


def test_many_headers_take_one_job_for_each_kind(spark, tmp_path):
    for k in range(60):
        (tmp_path / f"f{k:02d}.dat").write_text(SEP.join("abc" if k % 2 else "cba") + "\n" + SEP.join("123") + "\n")
    files = sorted("file:" + str(p) for p in tmp_path.glob("*.dat"))
    spark.sparkContext.setJobGroup("headers", "headers")
    found = readers.read_headers(spark, files)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[files[0]] == ("c", "b", "a") and found[files[1]] == ("a", "b", "c") and len(found) == 60
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 2


def broken_writer(real, fail_on):
    """A writer that fails at its n-th call."""
    calls = []

    def write(*args, **kwargs):
        calls.append(1)
        if len(calls) == fail_on:
            raise RuntimeError("no space")
        return real(*args, **kwargs)

    return write


def test_a_failed_contact_run_leaves_the_last_feed(spark, tmp_path, monkeypatch):
    ring = KeyRing({"8000": "aa" * 16, "1": "bb" * 16})
    cfg, inbox, out = contact_feed.Settings(keys=ring, tags=("ConsentA",)), tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def land(*people):
        df = spark.createDataFrame([(p,) for p in people], "c string")
        tokens = [r[0] for r in df.select(ring.protect(F.col("c"), "8000")).collect()]
        rows = [SEP.join([p, "P", "Ann", "Lee", "1990-01-01", "EMAIL", token, "", "Site", "1", "EN"]) for p, token in zip(people, tokens)]
        (inbox / "ConsentA.dat").write_text("\n".join([SEP.join(fixed.CONTACT_COLUMNS), *rows, "half a line"]) + "\n")

    def shown():
        back = readers.read_delimited(spark, publishing.published(spark, out, "feed", "cohort"))
        return sorted(r.PATIENT_ID for r in back.collect())

    land("1", "2")
    first = contact_feed.run(spark, str(inbox), out, cfg)
    assert (first.malformed, first.published) == (1, ["ConsentA"]) and shown() == ["1", "2"]
    assert lines(tmp_path.__class__(publishing.published(spark, out, "malformed", "cohort")[0])) == ["half a line"]
    land("3")
    for fail_on in (1, 2):
        with monkeypatch.context() as patch:
            patch.setattr(contact_feed, "write_with_manifest", broken_writer(writers.write_with_manifest, fail_on))
            try:
                contact_feed.run(spark, str(inbox), out, cfg)
            except RuntimeError:
                pass
            else:
                raise AssertionError("the run must fail")
        assert shown() == ["1", "2"] and len(list((tmp_path / "out" / "runs").iterdir())) == 1
    # a feed that does not read back as written is not published either
    with monkeypatch.context() as patch:
        patch.setattr(contact_feed, "verify_written", lambda spark, path, seen, *a: writers.verify_written(spark, path, seen | {"checksum_2": 1}, *a))
        assert contact_feed.run(spark, str(inbox), out, cfg).published == []
    assert shown() == ["1", "2"]
    assert contact_feed.run(spark, str(inbox), out, cfg).published == ["ConsentA"] and shown() == ["3"]


def test_of_two_overlapping_runs_the_first_to_commit_is_published(spark, tmp_path):
    out = str(tmp_path / "out")

    def write(run, text):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(run.path("part"))

    with publishing.Publication(spark, out) as slow, publishing.Publication(spark, out) as fast:
        write(slow, "slow")
        write(fast, "fast")
        assert fast.commit(["a", "b"]) == ["a", "b"]
        assert slow.commit(["b", "c"]) == ["c"]
    folders = publishing.current(spark, out)
    assert {k: f.rsplit("/", 1)[1] == fast.folder.rsplit("/", 1)[1] for k, f in folders.items()} == {"a": True, "b": True, "c": False}
    with publishing.Publication(spark, out) as late:
        write(late, "late")
        assert publishing.Publication(spark, out).commit(["a"]) == ["a"]
        assert late.commit(["a"]) == []
    assert not (tmp_path / "out" / late.folder).exists()


def test_superseded_runs_are_deleted_after_a_while(spark, tmp_path):
    out = str(tmp_path / "out")
    for k in range(6):
        with publishing.Publication(spark, out) as run:
            spark.createDataFrame([(str(k),)], "value string").coalesce(1).write.text(run.path("part"))
            assert run.commit(["feed"]) == ["feed"]
    assert len(list((tmp_path / "out" / "runs").iterdir())) == 1 + publishing.KEPT_RUNS
    assert [r.value for r in spark.read.text(publishing.published(spark, out, "part")).collect()] == ["5"]


def test_manifest_tells_rows_apart(spark):
    seen = lambda *rows: tuple(writers.manifest(spark.createDataFrame(list(rows), "a string, b string")).first())
    assert seen(("a|b", "c"), (None, "z")) != seen(("a", "b|c"), ("", "z"))
    assert seen(("1:x", "y")) != seen(("", "1:x1:y")) and seen((None, None)) != seen(("N", None))
    assert seen(("x", "y"), ("x", "y"), ("p", "q")) != seen(("x", "y"), ("p", "q"), ("p", "q"))
    assert seen(("x", "y"), ("p", "q")) == seen(("p", "q"), ("x", "y"))


def test_read_back_finds_what_the_format_cannot_hold(spark, tmp_path):
    good = [("a b", None, ""), (" cut ", "q\"uote", "c,|d"), ("", "  ", "é")]
    for name, rows, ok in (("good", good, True), ("bad", [*good, ("line\nbreak", "x", "y")], False)):
        df = spark.createDataFrame(rows, "a string, b string, c string")
        seen = writers.write_with_manifest(spark, df, str(tmp_path / name))
        assert writers.verify_written(spark, str(tmp_path / name), seen, df.columns).first().ok is ok


def test_altered_tokens_do_not_open(spark):
    ring = KeyRing({"1": "cc" * 16, "2": "dd" * 16})
    clear = "hello world, a text of some blocks é"
    token = spark.createDataFrame([(clear,)], "c string").select(F.unbase64(ring.protect(F.col("c"), "1"))).first()[0]
    changed = [bytes(b ^ (1 << bit) if i == at else b for i, b in enumerate(token)) for at in range(len(token)) for bit in (0, 5)]
    rows = [(token,), *[(c,) for c in changed], (bytes(token[:-16]),), (bytes(token) + b"0" * 16,), (b"",)]
    df = spark.createDataFrame(rows, "raw binary").select(F.base64("raw").alias("t"))
    found = [r[0] for r in df.select(ring.unprotect(F.col("t"), "1")).collect()]
    assert found == [clear] + [None] * (len(rows) - 1)
    assert df.limit(1).select(ring.unprotect(F.col("t"), "2")).first()[0] is None
    moved = df.select(ring.unprotect(ring.reprotect(F.col("t"), "1", "2"), "2")).collect()
    assert [r[0] for r in moved] == found


def test_contact_feed_needs_its_columns_and_sets_unreadable_rows_aside(spark, tmp_path):
    ring = KeyRing({"8000": "aa" * 16, "1": "bb" * 16})
    cfg = contact_feed.Settings(keys=ring, tags=("ConsentA",))
    inbox = tmp_path / "in"
    inbox.mkdir()
    values = ["7", "P", "Ann", "Lee", "1990-01-01", "EMAIL", "no token", "", "Site", "1", "EN"]
    (inbox / "ConsentA.dat").write_text(SEP.join(fixed.CONTACT_COLUMNS) + "\n" + SEP.join(values) + "\n")
    result = contact_feed.run(spark, str(inbox), str(tmp_path / "out"), cfg)
    assert result.manifest["rows"] == 0 and result.unreadable == 1 and result.check.first().ok
    (inbox / "ConsentA.dat").write_text("EMAIL" + SEP + "DOB\nx" + SEP + "y\n")
    try:
        contact_feed.run(spark, str(inbox), str(tmp_path / "out2"), cfg)
    except ValueError as error:
        assert "PATIENT_ID" in str(error)
    else:
        raise AssertionError("missing columns must raise")
