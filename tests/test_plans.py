"""Query plans: what must and must not appear in them."""

import contextlib
import datetime as dt
import re
import time
from base64 import b64encode

from pyspark.sql import functions as F

from feedweave.catalog import QUERIES, feeds, shapes
from feedweave.catalog.registry import Tables
from feedweave.functions.dates import compact_date_window
from feedweave.functions.privacy import base64_line
from feedweave.functions.text import cleaned_together
from feedweave.operators import lookups
from feedweave.operators.lookups import exclude_if_in, flag_if_in
from feedweave.operators.totals import total_per_group
from feedweave.plans import claim_layout, fixed_extract, purchase_feed
from feedweave.sources import readers, staging

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cross_join(spark):
    for name in ("purchase_feed", "fixed_extract_totals", "contact_feed", "excl_terms_by_join", "flag_from_lookup"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoop", text), name


def test_latest_row_is_cut_before_the_shuffle(spark):
    for name in ("latest_per_key", "dedup_keys"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert text.count("WindowGroupLimit") == 2, name


def test_existence_tests_are_semi_and_anti_joins(spark):
    assert "LeftSemi" in plan(QUERIES["semi_allowed"](spark, FOLDER))
    assert "LeftAnti" in plan(QUERIES["anti_opt_out"](spark, FOLDER))


def test_raw_date_filter_reaches_the_reader(spark, tmp_path):
    t = Tables(spark, FOLDER)
    path = str(tmp_path / "sales")
    t.orders.selectExpr("o_orderkey", "date_format(o_orderdate, 'yyyyMMdd') AS day").write.parquet(path)
    rows = spark.read.parquet(path).filter(compact_date_window(F.col("day"), dt.date(1996, 1, 1), dt.date(1996, 1, 2)))
    assert "GreaterThanOrEqual(day,19960101)" in plan(rows)


def test_scans_read_only_needed_columns(spark):
    text = plan(QUERIES["dedup_rows"](spark, FOLDER))
    assert re.search(r"ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_returnflag:string,l_linestatus:string>", text)


@contextlib.contextmanager
def small_partitions(spark):
    """Settings under which a few thousand rows of one key count as skewed."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "30KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_keys_are_split(spark):
    """One key holds most rows: adaptive execution splits it, and the result stays right."""
    rows = spark.range(0, 60000, 1, 8).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 0 ELSE id % 500 END AS k", "id AS rest", "1 AS qty"
    )
    lookup = spark.range(0, 500, 2).toDF("id")
    with small_partitions(spark):
        for df in (
            total_per_group(rows, ["k"], "qty", "total"),
            flag_if_in(rows, lookup, {"k": "id"}, "hit"),
            exclude_if_in(rows, lookup, {"k": "id"}),
        ):
            df.write.format("noop").mode("overwrite").save()
            collected = df.collect()
            assert "skewed" in plan(df), plan(df)
        total = {r.k: r.total for r in total_per_group(rows, ["k"], "qty", "total").collect()}
        assert sum(total.values()) == 60000 and total[0] > 40000
        assert len(collected) == rows.filter("k % 2 = 1").count()


def test_hot_loyalty_id_and_transaction_in_the_feed(spark):
    """Most lines belong to one person and one transaction: header and identity joins split them."""
    hot = "CASE WHEN id % 3 > 0 THEN 0 ELSE id % 500 END"
    typed = spark.range(0, 60000, 1, 8).selectExpr(
        "1100 AS RECORDTYP", f"cast({hot} AS string) AS RFN", "'19960101' AS SALES_TXN_DT", "'s' AS STORE_NBR", "id AS UPC_NBR",
        "cast(id AS string) AS ARTICLE_NBR", "1 AS LINE_ITEM_SEQ_NBR", "1 AS UNIT_QTY", "cast(1 AS decimal(18,2)) AS PRICE",
        "cast(NULL AS string) AS LOYALTY_ID",
    )
    headers = spark.range(1000).selectExpr(
        "1000 AS RECORDTYP", "cast(id % 500 AS string) AS RFN", "'19960101' AS SALES_TXN_DT", "'s' AS STORE_NBR",
        "cast(NULL AS bigint) AS UPC_NBR", "cast(NULL AS string) AS ARTICLE_NBR", "cast(NULL AS int) AS LINE_ITEM_SEQ_NBR",
        "cast(NULL AS int) AS UNIT_QTY", "cast(NULL AS decimal(18,2)) AS PRICE", "cast(id % 500 AS string) AS LOYALTY_ID",
    )
    people = spark.range(500).selectExpr("id AS mid", "explode(array('LR', 'EC')) AS cust_src_cd").selectExpr(
        "mid", "cust_src_cd", "cast(mid AS string) AS cust_src_id",
        "timestamp_ntz'2024-01-01 00:00:00' AS dna_update_dttm", "'9999-12-31 00:00:00' AS dna_end_dttm",
    )
    with small_partitions(spark):
        lines = purchase_feed.loyalty_lines(typed.unionByName(headers))
        assert lines.count() == 60000
        lines.write.format("noop").mode("overwrite").save()
        lines.collect()
        assert "skewed" in plan(lines)
        known = typed.drop("LOYALTY_ID").withColumn("LOYALTY_ID", F.col("RFN"))
        found = purchase_feed.attach_identity(known, people)
        assert len(found.collect()) == 60000
        assert "skewed" in plan(found)


def test_totals_read_the_detail_once(spark):
    df = QUERIES["agg_broadcast_back"](spark, FOLDER)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_records_are_split_in_one_pass(spark):
    df = QUERIES["layout_split"](spark, FOLDER)
    df.collect()
    assert plan(df).split("Initial Plan")[0].count("FileScan") == 2  # lines and orders, once each


def test_listed_texts_travel_as_keys(spark):
    """The substrings of a long text are not shuffled with the text."""
    from feedweave.operators.lookups import keys_with_terms

    texts = spark.range(3).selectExpr("concat(repeat('abc ', 500), id) AS t")
    terms = spark.range(2000).selectExpr("concat('c ', id) AS term")
    text = plan(keys_with_terms(texts, "t", terms, "term"))
    pieces = [line for line in text.splitlines() if "Generate explode(array_distinct" in line and "text" in line]
    assert pieces and all(re.search(r"\), (\[key#\d+\], )?false, \[piece", line) for line in pieces)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop", text)
    assert keys_with_terms(texts, "t", terms, "term").count() == 3


def test_terms_of_many_lengths_in_a_long_text(spark):
    """The work does not grow with the number of lengths, and a text of a megabyte is no burden."""
    from feedweave.operators.lookups import keys_with_terms

    long = spark.range(1).selectExpr("concat(repeat('ab é', 250000), 'needle', repeat('xyz', 100)) AS t")
    texts = long.unionByName(spark.createDataFrame([("short needle",), ("é",), ("nothing",), ("NEEDLE",), ("",), (None,)], "t string"))
    terms = spark.range(4, 54).selectExpr("concat('needle', repeat('xyz', int(id))) AS term")
    more = spark.createDataFrame([("é",), ("zq",), ("t n",), ("é" * 5,), ("",), (None,)], "term string")
    found = keys_with_terms(texts, "t", terms.unionByName(more), "term")
    keys = {r.key for r in found.collect()}
    expected = texts.filter("t IS NOT NULL AND (t LIKE '%needlexyz%' OR t LIKE '%é%' OR t LIKE '%t n%')")
    assert keys == {r.key for r in expected.select(F.sha2("t", 256).alias("key")).collect()} and len(keys) == 3


def test_a_window_opens_only_the_files_of_its_days(spark, tmp_path):
    """Of all staged days a two-day window lists two folders; a hot day is dealt over several tasks."""
    t, path = Tables(spark, FOLDER), str(tmp_path / "staged")
    days = t.orders.selectExpr("o_orderkey", "date_format(o_orderdate, 'yyyyMMdd') AS day")
    staging.stage_by_day(days, path, "day")
    cfg = purchase_feed.Settings.for_run(dt.date(1996, 6, 2))
    rows = staging.read_days(spark, path, days.schema, cfg.first_day, cfg.last_day)
    text = plan(rows)
    assert re.search(r"PartitionFilters: \[.*__day#\d+ >= d19960601.*__day#\d+ <= d19960602", text)
    scan = rows._jdf.queryExecution().sparkPlan().collectLeaves().head()
    chosen = scan.selectedPartitions().toPartitionArray()
    files = [chosen[k].filePath().toString() for k in range(len(chosen))]
    assert {re.search(r"__day=d(\d+)", f)[1] for f in files} <= {"19960601", "19960602"}
    all_days = days.filter(compact_date_window(F.col("day"), cfg.first_day, cfg.last_day))
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, all_days.collect()))
    # only the days that occur are replaced
    staging.stage_by_day(spark.createDataFrame([(-1, "19960601")], days.schema), path, "day")
    assert [r.o_orderkey for r in staging.read_days(spark, path, days.schema, cfg.first_day, cfg.first_day).collect()] == [-1]
    assert staging.read_days(spark, path, days.schema, dt.date(1992, 1, 1), dt.date(1992, 12, 31)).count() == days.filter("day LIKE '1992%'").count()


def test_a_hot_day_is_staged_by_several_tasks(spark, tmp_path):
    path = tmp_path / "staged"
    rows = spark.range(0, 200000, 1, 8).selectExpr("id", "sha2(cast(id AS string), 256) AS rest", "CASE WHEN id % 3 > 0 THEN '20240101' ELSE '20240102' END AS day")
    with small_partitions(spark):
        staging.stage_by_day(rows, str(path), "day")
    assert len(list((path / "__day=d20240101").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 200000


def test_staged_sales_meet_without_a_shuffle(spark, tmp_path):
    """Header join, line keys and item totals over a staged table: no exchange, also with a hot transaction, whose rows are spread."""
    t = Tables(spark, FOLDER)
    hot = "CASE WHEN l_orderkey % 3 > 0 THEN 'hot' ELSE cast(l_orderkey AS string) END"
    made = t.lineitem.selectExpr(
        "1100 AS RECORDTYP", f"{hot} AS RFN", "'19960101' AS SALES_TXN_DT", "cast(l_suppkey AS string) AS STORE_NBR",
        "cast(l_partkey AS string) AS UPC_NBR", "cast(l_partkey AS string) AS ARTICLE_NBR", "cast(l_linenumber AS string) AS LINE_ITEM_SEQ_NBR",
        "cast(l_quantity AS string) AS UNIT_QTY", "cast(l_extendedprice AS double) AS ITEM_UNIT_PRICE_DLRS", "cast(NULL AS string) AS loyalty_id",
    )
    head = made.select("RFN", "STORE_NBR").distinct().selectExpr(
        "1000 AS RECORDTYP", "RFN", "'19960101' AS SALES_TXN_DT", "STORE_NBR", "cast(NULL AS string) AS UPC_NBR", "cast(NULL AS string) AS ARTICLE_NBR",
        "cast(NULL AS string) AS LINE_ITEM_SEQ_NBR", "cast(NULL AS string) AS UNIT_QTY", "cast(NULL AS double) AS ITEM_UNIT_PRICE_DLRS", "concat('L', RFN) AS loyalty_id",
    )
    sales = made.unionByName(head)
    cfg = purchase_feed.Settings(dt.date(1996, 1, 1), dt.date(1996, 12, 31))
    totals = lambda s: purchase_feed.item_totals(purchase_feed.loyalty_lines(purchase_feed.sales_in_window(s, cfg)))
    expected = sorted(map(tuple, totals(sales).select(*(columns := totals(sales).columns)).collect()))
    kept = {k: spark.conf.get(k) for k in purchase_feed.CO_LOCATED}
    try:
        for k, v in purchase_feed.CO_LOCATED.items():
            spark.conf.set(k, v)
        staged = purchase_feed.stage_sales(sales, "staged_sales_test", str(tmp_path / "sales"), buckets=16, hot_rows=500, slices=64)
        with small_partitions(spark):
            found = totals(staged)
            assert "Exchange" not in plan(found) and "SortMergeJoin" in plan(found)
            assert sorted(map(tuple, found.select(*columns).collect())) == expected and len(expected) > 1000
        hot_rows = staged.filter("RFN = 'hot' AND RECORDTYP = 1100")
        sizes = [r["count"] for r in hot_rows.groupBy(F.regexp_extract("_metadata.file_name", "_([0-9]+)[.]", 1)).count().collect()]
        assert len(sizes) >= 12 and max(sizes) < sum(sizes) / 4
        assert staged.filter("RECORDTYP = 1100").count() == made.count()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE IF EXISTS staged_sales_test")


def test_claims_are_not_shuffled_for_small_lookups(spark):
    """A lookup of few keys taken from many rows: its keys are stored first, so that Spark knows them to be few."""
    t = Tables(spark, FOLDER)
    cfg = feeds.extract_settings(claim_layout.VARIANT_2)
    many = spark.range(10_000_000).selectExpr("'WI' AS STATE_CD", "cast(id % 10 AS string) AS zip_3", "'XXMED' AS THIRD_PARTY_PLAN_ID",
                                              "'G1' AS PLAN_GROUP_NBR", "cast(id % 10 AS string) AS GENERIC_PROD_ID")
    side = fixed_extract.Lookups(many, t.values("prod_name", "('ring')"), many, many, many)
    text = plan(fixed_extract.records(fixed_extract.mark(feeds.protected_claims(t, cfg.keys), side, cfg), cfg))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 5


def test_landed_rows_are_not_shuffled_for_their_paths(spark, tmp_path):
    (tmp_path / "one.dat").write_text("a\u0001b\n1\u00012\n")
    landed = readers.read_landed(spark, [str(tmp_path / "one.dat")], ["a", "b"], "file", "damaged")
    assert "SortMergeJoin" not in plan(landed.rows) and landed.rows.count() == 1


def test_rows_left_out_are_not_opened(spark):
    """Excluded claims keep their file only; what is formatted is as before."""
    t = Tables(spark, FOLDER)
    cfg = feeds.extract_settings(claim_layout.VARIANT_2)
    marked = fixed_extract.mark(feeds.protected_claims(t, cfg.keys), feeds.claim_lookups(t), cfg)
    out = marked.filter(F.col(fixed_extract.EXCLUDED).isNotNull())
    texts = [c for c in marked.columns if c.startswith(claim_layout.CLEAR) or c in claim_layout.PROTECTED]
    seen = out.agg(F.count("*"), F.count(fixed_extract.FILE), *[F.count(c) for c in texts]).first()
    assert seen[0] == seen[1] > 0 and len(texts) == 12 and not any(seen[2:])


def test_long_tokens_stay_on_one_line(spark):
    lengths = [1, 30, 57, 58, 400]
    rows = spark.createDataFrame([("x" * n,) for n in lengths], "c string").select(base64_line(F.col("c").cast("binary"))).collect()
    assert [r[0] for r in rows] == [b64encode(b"x" * n).decode() for n in lengths]


def test_buckets_grow_with_the_staged_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(purchase_feed, "BUCKET_ROWS", 100)
    sales = spark.range(3000).selectExpr("1100 AS RECORDTYP", "cast(id % 1000 AS string) AS RFN", "cast(id AS string) AS UPC_NBR")
    try:
        staged = purchase_feed.stage_sales(sales, "staged_sales_grown", str(tmp_path / "sales"), buckets=2)
        sizes = [r["count"] for r in staged.groupBy("_metadata.file_name").count().collect()]
        assert len(sizes) >= 25 and sum(sizes) == 3000 and max(sizes) < 300
    finally:
        spark.sql("DROP TABLE IF EXISTS staged_sales_grown")


def test_headers_of_the_sales_are_made_once_in_all_partitions(spark):
    """Both copies of a header come from one aggregate, whose partitions are not merged by their compressed size."""
    sales = shapes.sales(Tables(spark, FOLDER))
    text = plan(sales)
    assert "REPARTITION_BY_NUM" in text and "Generate" in text and text.count("HashAggregate") == 2
    headers = sales.filter("RECORDTYP = 1000").groupBy("RFN", "SALES_TXN_DT", "STORE_NBR", "loyalty_id").count()
    assert {r[0] for r in headers.select("count").distinct().collect()} == {2}


def test_header_partitions_grow_with_the_item_lines(spark, monkeypatch):
    """A task makes the headers of a bounded number of lines distinct, however many lines there are."""
    t = Tables(spark, FOLDER)
    lines = t.lineitem.count()
    monkeypatch.setattr(shapes, "HEADER_ROWS", 100)
    (parts,) = re.findall(r"hashpartitioning\(RFN[^)]*, (\d+)\), REPARTITION_BY_NUM", plan(shapes.sales(t)))
    assert int(parts) == -(-lines // 100) > 4
    monkeypatch.setattr(shapes, "HEADER_ROWS", 10 * lines)
    (parts,) = re.findall(r"hashpartitioning\(RFN[^)]*, (\d+)\), REPARTITION_BY_NUM", plan(shapes.sales(t)))
    assert int(parts) == 4


def test_claims_stay_packed_through_their_joins(spark):
    """The texts that no lookup needs are unpacked once, above all joins, and rows left out keep nothing but their file."""
    t = Tables(spark, FOLDER)
    cfg = feeds.extract_settings(claim_layout.VARIANT_2)
    marked = fixed_extract.mark(feeds.protected_claims(t, cfg.keys), feeds.claim_lookups(t), cfg)
    above, _, below = plan(fixed_extract.records(marked, cfg)).partition("BroadcastHashJoin")
    assert "__row" in above and "_extract_" not in below
    left_out = marked.filter(F.col(fixed_extract.EXCLUDED).isNotNull()).drop(fixed_extract.FILE, fixed_extract.EXCLUDED, fixed_extract.SUPPRESSED)
    seen = left_out.agg(F.count("*"), *[F.count(c) for c in left_out.columns if c != "free_goods_ind"]).first()
    assert seen[0] > 0 and not any(seen[1:])


def test_texts_that_hold_the_joining_character_are_cleaned_one_by_one(spark):
    rows = spark.createDataFrame([(1, "a*b", "c_"), (2, "a\u0001*b", "c_"), (3, None, "\u0001")], "id int, x string, y string")
    made = rows.select("id", cleaned_together([F.col("x"), F.col("y")]).alias("p")).orderBy("id")
    assert [r.p for r in made.collect()] == [["ab", "c"], ["ab", "c"], ["", ""]]
    # a lambda over the joined texts would be run without generated code, for every row
    assert "filter(array(split(" not in plan(made)


def test_shuffle_files_go_when_their_query_ends(spark):
    """A job of several queries needs the disk of its largest one; a result that is asked for again is made again."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    rows = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    before = shuffled()
    rows.write.format("noop").mode("overwrite").save()
    until = time.time() + 10
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert len(rows.collect()) == len(rows.collect()) == 7


def test_item_lines_of_claims_are_shuffled_by_part_and_by_order_only(spark):
    """With no small side: orders meet customers apart, and no shuffle of whole rows follows the joins."""
    with small_partitions(spark):
        claims = shapes.claims(Tables(spark, FOLDER))
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan(claims))
    assert sorted(re.sub(r"#\d+L?", "", k) for k in keys) == ["l_orderkey", "l_partkey", "l_suppkey", "o_orderkey", "p_partkey", "s_suppkey"]
    assert claims.count() == Tables(spark, FOLDER).lineitem.count()


def test_wide_rows_are_made_once_for_their_texts(spark, monkeypatch):
    """The index of pieces uses the texts several times: it gets them stored, not the rows they come from."""
    seen, found_in = [], lookups.keys_with_terms
    monkeypatch.setattr(lookups, "keys_with_terms", lambda df, *args: seen.append(df) or found_in(df, *args))
    rows = spark.range(6).selectExpr("id", "element_at(array('ring', 'a ring', '', NULL, 'rin', 'ring'), int(id + 1)) AS t")
    terms = spark.createDataFrame([("ring",)], "term string")
    flagged = lookups.flag_terms(rows, "t", terms, "term", "hit", wide=True)
    assert [r.hit for r in flagged.orderBy("id").collect()] == [True, True, False, False, False, True]
    assert "FileScan" in plan(seen[0]) and "Range" not in plan(seen[0]) and seen[0].count() == 3


def test_a_large_table_is_staged_in_passes(spark, tmp_path, monkeypatch):
    """Each pass shuffles a part of the transactions; rows, slices and co-location are those of a single pass."""
    rfn = "CASE WHEN id % 10 = 0 THEN 'hot' WHEN id % 10 < 9 THEN cast(id % 700 AS string) END"
    sales = spark.range(3000).selectExpr("CASE WHEN id % 4 = 0 THEN 1000 ELSE 1100 END AS RECORDTYP", f"{rfn} AS RFN", "cast(id % 90 AS string) AS UPC_NBR", "id")
    asked, flag = [], lookups.flag_if_in
    monkeypatch.setattr(lookups, "flag_if_in", lambda df, *args, **kw: asked.append(df.count()) or flag(df, *args, **kw))
    kept = {k: spark.conf.get(k) for k in purchase_feed.CO_LOCATED}
    try:
        for k, v in purchase_feed.CO_LOCATED.items():
            spark.conf.set(k, v)
        whole = purchase_feed.stage_sales(sales, "staged_sales_whole", str(tmp_path / "whole"), buckets=4, hot_rows=100, slices=8)
        monkeypatch.setattr(purchase_feed, "PASS_ROWS", 1000)
        passed = purchase_feed.stage_sales(sales, "staged_sales_passed", str(tmp_path / "passed"), buckets=4, hot_rows=100, slices=8)
        assert len(asked) == 1 + purchase_feed.PASSES and asked[0] == sum(asked[1:]) == 3000 and max(asked[1:]) < 2000
        rows = [sorted(map(str, s.collect())) for s in (whole, passed)]
        assert rows[0] == rows[1] and len(rows[0]) > 3000
        with small_partitions(spark):
            both = passed.join(passed.withColumnsRenamed({c: f"__{c}" for c in passed.columns}), F.expr(f"RFN = __RFN AND {purchase_feed.SLICE} = __{purchase_feed.SLICE}"))
            assert "Exchange" not in plan(both)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
        for name in ("whole", "passed"):
            spark.sql(f"DROP TABLE IF EXISTS staged_sales_{name}")
