"""Filters, date windows, listed terms."""

import datetime as dt

from pyspark.sql import functions as F

from ..functions.dates import compact_date_window
from ..functions.text import is_filled
from ..operators import filters, lookups
from ..plans import purchase_feed
from ..session import scratch_path
from ..sources import staging
from . import shapes
from .registry import Tables, query
from .shapes import CODES, NAME_PART

RUN_DATE = dt.date(1996, 6, 2)


@query(
    "window_two_day",
    "SELECT o_orderkey, cast(o_orderdate AS DATE) AS o_orderdate FROM orders "
    "WHERE cast(o_orderdate AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-06-02'",
)
def window_two_day(t: Tables):
    """The feed's own window, on raw text."""
    cfg = purchase_feed.Settings.for_run(RUN_DATE)
    rows = order_days(t).filter(compact_date_window(F.col("day"), cfg.first_day, cfg.last_day))
    return rows.select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))


def order_days(t: Tables):
    return t.orders.selectExpr("o_orderkey", "o_orderdate", "date_format(o_orderdate, 'yyyyMMdd') AS day")


@query(
    "window_staged",
    "SELECT 'day' AS part, o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders "
    "WHERE o_orderkey % 5 > 0 AND cast(o_orderdate AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-06-02' "
    "UNION ALL SELECT 'no day', o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN strftime(o_orderdate, '%Y%m') || '99' END FROM orders "
    "WHERE o_orderkey % 5 = 0",
)
def window_staged(t: Tables):
    """The window over a table staged by day in two writes; texts that are no day are kept apart."""
    cfg, path = purchase_feed.Settings.for_run(RUN_DATE), scratch_path(t.spark, "staged")
    broken = "CASE o_orderkey % 10 WHEN 0 THEN date_format(o_orderdate, 'yyyyMM') || '99' END"
    rows = order_days(t).selectExpr("o_orderkey", f"CASE WHEN o_orderkey % 5 = 0 THEN {broken} ELSE day END AS day")
    staging.stage_by_day(rows.filter("day IS NULL OR day < '19960602' OR day LIKE '%99'"), path, "day")
    staging.stage_by_day(rows.filter("day >= '19960602' AND day NOT LIKE '%99'"), path, "day")
    window = staging.read_days(t.spark, path, rows.schema, cfg.first_day, cfg.last_day)
    others = t.spark.read.schema(rows.schema).parquet(f"{path}/{staging.DAY}={staging.NO_DAY}")
    return window.selectExpr("'day' AS part", "*").unionByName(others.selectExpr("'no day' AS part", "*"))


IN_WINDOW = (
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 17 <> 0 AND l_orderkey % 23 <> 0 "
    "AND cast(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
)
SALE = "cast(l_orderkey AS VARCHAR) AS rfn, cast(l_suppkey AS VARCHAR) AS site"
WINDOW = purchase_feed.Settings(dt.date(1996, 1, 1), dt.date(1996, 12, 31))


@query(
    "flt_record_type",
    f"""
    SELECT 1100 AS kind, {SALE}, l_partkey AS upc,
      cast(CASE WHEN l_quantity = 13 THEN -l_quantity ELSE l_quantity END AS INTEGER) AS qty {IN_WINDOW} AND l_quantity <> 15
    UNION ALL SELECT 1000, rfn, site, NULL, NULL
    FROM (SELECT DISTINCT {SALE}, o_custkey {IN_WINDOW}) CROSS JOIN (VALUES (1), (2)) AS twice(n)
    """,
)
def flt_record_type(t: Tables):
    """Typed sales of the window: other record types, blank ids and dates that do not exist leave."""
    return purchase_feed.sales_in_window(shapes.sales(t), WINDOW).select(
        F.col("RECORDTYP").alias("kind"), F.col("RFN").alias("rfn"), F.col("STORE_NBR").alias("site"),
        F.col("UPC_NBR").alias("upc"), F.col("UNIT_QTY").alias("qty"),
    )


@query(
    "flt_non_negative",
    f"SELECT {SALE}, cast(l_linenumber AS INTEGER) AS line, cast(l_quantity AS INTEGER) AS qty {IN_WINDOW} "
    "AND l_quantity NOT IN (13, 15) AND o_custkey % 19 <> 0",
)
def flt_non_negative(t: Tables):
    lines = purchase_feed.loyalty_lines(purchase_feed.sales_in_window(shapes.sales(t), WINDOW))
    return lines.select(
        F.col("RFN").alias("rfn"), F.col("STORE_NBR").alias("site"), F.col("LINE_ITEM_SEQ_NBR").alias("line"),
        F.col("UNIT_QTY").alias("qty"),
    )


SEGMENT = "CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '   ' ELSE c_mktsegment END"


@query(
    "flt_non_blank",
    f"SELECT * FROM (SELECT c_custkey, {SEGMENT} AS segment FROM customer) WHERE trim(segment) <> ''",
)
def flt_non_blank(t: Tables):
    return t.customer.selectExpr("c_custkey", f"{SEGMENT} AS segment").filter(is_filled(F.col("segment")))


ORDER_HOLES = (
    "o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, "
    "nullif(o_orderpriority, '5-LOW') AS priority, nullif(o_custkey % 10, 3) AS bucket"
)


@query(
    "flt_complete_rows",
    f"SELECT * FROM (SELECT {ORDER_HOLES} FROM orders) "
    "WHERE status IS NOT NULL AND priority IS NOT NULL AND bucket IS NOT NULL",
)
def flt_complete_rows(t: Tables):
    rows = t.orders.selectExpr(
        "o_orderkey", "o_custkey", "nullif(o_orderstatus, 'P') AS status",
        "nullif(o_orderpriority, '5-LOW') AS priority", "nullif(o_custkey % 10, 3) AS bucket",
    )
    return filters.complete_rows(rows, ["status", "priority", "bucket"])


@query(
    "flt_not_in_codes",
    "SELECT p_partkey, size FROM (SELECT p_partkey, nullif(p_size, 3) AS size FROM part) WHERE size NOT IN (7, 17, 21)",
)
def flt_not_in_codes(t: Tables):
    rows = t.part.selectExpr("p_partkey", "nullif(p_size, 3) AS size")
    return filters.exclude_codes(rows, "size", CODES)


@query(
    "excl_sensitive_category",
    "SELECT p_partkey, p_name, p_size FROM part WHERE NOT (p_name LIKE '%ring%' OR p_size IN (7, 17, 21))",
)
def excl_sensitive_category(t: Tables):
    rows = t.part.select("p_partkey", "p_name", "p_size")
    return filters.exclude_sensitive_category(rows, "p_name", "p_size", NAME_PART, CODES)


PLACE = (
    "nullif('n' || cast(c_nationkey AS string), 'n5')",
    "c_mktsegment",
)


@query(
    "excl_region",
    f"SELECT * FROM (SELECT c_custkey, {PLACE[0]} AS state, {PLACE[1]} AS city FROM customer) "
    "WHERE lower(state) NOT IN ('n3') AND lower(city) NOT LIKE '%house%'",
)
def excl_region(t: Tables):
    rows = t.customer.selectExpr("c_custkey", f"{PLACE[0]} AS state", f"{PLACE[1]} AS city")
    return filters.exclude_region(rows, "state", ["N3"], "city", "House")


NAMES = "CASE p_size WHEN 1 THEN NULL WHEN 2 THEN '' ELSE p_name END"
TERM_ROWS = ("('ring')", "('cold g')", "(' ring ')", "('')", "(NULL)")


def _named_parts(t: Tables):
    return t.part.selectExpr("p_partkey", f"{NAMES} AS name")


@query(
    "excl_terms",
    f"SELECT * FROM (SELECT p_partkey, {NAMES} AS name FROM part) "
    "WHERE name IS NULL OR (name NOT LIKE '%ring%' AND name NOT LIKE '%cold g%')",
)
def excl_terms(t: Tables):
    return lookups.exclude_terms(_named_parts(t), "name", t.values("term", *TERM_ROWS), "term")


@query(
    "excl_terms_by_join",
    f"SELECT * FROM (SELECT p_partkey, {NAMES} AS name FROM part) WHERE name IS NULL OR name = '' "
    "OR NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT p_name AS term FROM part WHERE p_brand = 'Brand#5') "
    "WHERE contains(name, term))",
)
def excl_terms_by_join(t: Tables):
    terms = t.part.filter("p_brand = 'Brand#5'").select(F.col("p_name").alias("term"))
    return lookups.exclude_terms(_named_parts(t), "name", terms, "term")


@query(
    "excl_terms_count",
    f"SELECT count(*) AS excluded FROM (SELECT {NAMES} AS name FROM part) "
    "WHERE name LIKE '%ring%' OR name LIKE '%cold g%'",
)
def excl_terms_count(t: Tables):
    return lookups.count_terms(_named_parts(t), "name", t.values("term", *TERM_ROWS), "term", "excluded")


MAIL = (
    "CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 'null' "
    "ELSE CASE o_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '\"\"' ELSE o_orderpriority END END"
)


@query(
    "flt_null_token",
    f"SELECT * FROM (SELECT o_orderkey, {MAIL} AS email FROM orders) WHERE email NOT IN ('null', '', '\"\"')",
)
def flt_null_token(t: Tables):
    return filters.drop_null_tokens(t.orders.selectExpr("o_orderkey", f"{MAIL} AS email"), "email")


@query(
    "scd_current",
    "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'",
)
def scd_current(t: Tables):
    history = t.events.selectExpr(
        "event_id", "user_id",
        "CASE WHEN event_type = 'purchase' THEN date'9999-12-31' ELSE cast(ts AS date) END AS end_day",
    )
    return filters.current_rows(history, "end_day").select("event_id", "user_id")
