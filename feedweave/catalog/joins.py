"""Joins of the purchase feed and the extract, over the test tables."""

import datetime as dt

from pyspark.sql import functions as F

from ..operators import lookups
from ..plans import purchase_feed
from ..plans.purchase_feed import Settings
from . import feeds, shapes
from .registry import Tables, query
from .shapes import CODES, NAME_PART, identity

WINDOW = Settings(dt.date(1990, 1, 1), dt.date(2020, 12, 31))
SALES = f"lineitem JOIN orders ON l_orderkey = o_orderkey WHERE {shapes.KEPT_SALES}"
LINE_SHAPE = (
    "cast(l_orderkey AS VARCHAR) AS rfn, l_partkey AS upc, cast(l_linenumber AS INTEGER) AS line, "
    "cast(l_quantity AS INTEGER) AS qty, cast(l_extendedprice AS DECIMAL(18,2)) AS price, cast(o_custkey AS VARCHAR) AS loyalty_id"
)


def _loyalty_lines(t: Tables):
    return purchase_feed.loyalty_lines(purchase_feed.sales_in_window(shapes.sales(t), WINDOW))


def _shown(lines, *more):
    return lines.select(
        F.col("RFN").alias("rfn"), F.col("UPC_NBR").alias("upc"), F.col("LINE_ITEM_SEQ_NBR").alias("line"),
        F.col("UNIT_QTY").alias("qty"), F.col("PRICE").alias("price"), F.col("LOYALTY_ID").alias("loyalty_id"), *more,
    )


# every header stands there twice and must not repeat its lines
@query("join_line_header", f"SELECT {LINE_SHAPE}, cast(l_suppkey AS VARCHAR) AS site FROM {SALES}")
def join_line_header(t: Tables):
    return _shown(_loyalty_lines(t), F.col("STORE_NBR").alias("site"))


@query(
    "join_store_map",
    f"SELECT {LINE_SHAPE}, cast(s_suppkey AS INTEGER) AS store FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    f"JOIN supplier ON l_suppkey = s_suppkey WHERE {shapes.KEPT_SALES} AND s_nationkey <> 3 AND s_suppkey % 11 <> 0",
)
def join_store_map(t: Tables):
    tables = feeds.purchase_tables(t)
    located = purchase_feed.mapped_stores(_loyalty_lines(t), tables.store_map, tables.stores, feeds.purchase_settings())
    return _shown(located, F.col("STORE_NBR").alias("store"))


@query(
    "identity_attach",
    """
    WITH newest AS (
      SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
      FROM events WHERE event_type = 'purchase')
    SELECT o_orderkey, cast(o_custkey AS VARCHAR) AS loyalty_id, cast(event_id AS VARCHAR) AS online_id
    FROM orders JOIN newest ON o_custkey = user_id AND n = 1
    """,
)
def identity_attach(t: Tables):
    lines = t.orders.selectExpr("o_orderkey", "cast(o_custkey AS string) AS LOYALTY_ID")
    joined = purchase_feed.attach_identity(lines, identity(t))
    return joined.select("o_orderkey", F.col("LOYALTY_ID").alias("loyalty_id"), F.col("ECOMM_ID").alias("online_id"))


# excluded pairs: part and supplier keys of one brand's parts at the suppliers of one nation
PAIRS = "SELECT l_partkey AS part_id, l_suppkey AS supp_id FROM lineitem WHERE l_quantity = 50"


def _pairs(t: Tables):
    return t.lineitem.filter("l_quantity = 50").selectExpr("l_partkey AS part_id", "l_suppkey AS supp_id")


@query(
    "excl_plan_pairs",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE NOT EXISTS "
    f"(SELECT 1 FROM ({PAIRS}) WHERE part_id = l_partkey AND supp_id = l_suppkey)",
)
def excl_plan_pairs(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return lookups.exclude_if_in(rows, _pairs(t), {"l_partkey": "part_id", "l_suppkey": "supp_id"})


@query(
    "flag_from_lookup",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN (l_partkey, l_suppkey) IN (SELECT (part_id, supp_id) FROM ({PAIRS}))
            AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20) THEN 'Y' ELSE 'N' END AS free_goods
    FROM lineitem
    """,
)
def flag_from_lookup(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    products = t.part.filter("p_size < 20").select("p_partkey")
    rows = lookups.flag_if_in(
        rows, _pairs(t), {"l_partkey": "part_id", "l_suppkey": "supp_id"}, "by_plan", yes=True, no=False
    )
    rows = lookups.flag_if_in(rows, products, {"l_partkey": "p_partkey"}, "by_product", yes=True, no=False)
    both = F.when(F.col("by_plan") & F.col("by_product"), "Y").otherwise("N")
    return rows.withColumn("free_goods", both).drop("by_plan", "by_product")


SKUS = (
    "SELECT cast(p_partkey AS VARCHAR) AS article, p_partkey AS upc, sku FROM part "
    "JOIN (SELECT p_partkey AS part, p_brand AS sku FROM part UNION SELECT p_partkey, p_type FROM part WHERE p_size % 2 = 0) "
    "ON part = p_partkey WHERE p_size NOT IN (7, 17, 21) AND p_name NOT LIKE '%ring%'"
)


@query("join_product_dim", SKUS)
def join_product_dim(t: Tables):
    products = purchase_feed.sellable_products(feeds.purchase_tables(t), feeds.purchase_settings())
    return products.select(
        F.col("ARTICLE_NBR").alias("article"), F.col("UPC_NBR").alias("upc"), F.col("SKU_ID").alias("sku")
    )


def _with_products(t: Tables):
    rows = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "cast(l_partkey AS string) AS ARTICLE_NBR", "l_partkey AS UPC_NBR"
    )
    return purchase_feed.with_products(rows, feeds.purchase_tables(t), feeds.purchase_settings())


# the facts that have a sellable product, each once
@query(
    "join_fact_product",
    f"SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN ({SKUS}) ON upc = l_partkey",
)
def join_fact_product(t: Tables):
    return _with_products(t).select("l_orderkey", "l_linenumber", "l_partkey").distinct()


# an assortment with several SKUs per article: it multiplies rows on purpose
@query(
    "join_assortment",
    f"SELECT l_orderkey, l_linenumber, l_partkey, sku FROM lineitem JOIN ({SKUS}) ON upc = l_partkey",
)
def join_assortment(t: Tables):
    return _with_products(t).select("l_orderkey", "l_linenumber", "l_partkey", F.col("SKU_ID").alias("sku"))


@query(
    "semi_allowed",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)
      AND o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey <> 3)
    """,
)
def semi_allowed(t: Tables):
    stores = t.supplier.filter("s_nationkey <> 3")
    sold = lookups.keep_if_in(t.lineitem.select("l_orderkey", "l_suppkey"), stores, {"l_suppkey": "s_suppkey"})
    people = t.customer.filter("c_nationkey <> 3")
    rows = lookups.keep_if_in(t.orders.select("o_orderkey", "o_custkey"), people, {"o_custkey": "c_custkey"})
    return lookups.keep_if_in(rows, sold, {"o_orderkey": "l_orderkey"})


@query(
    "anti_opt_out",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def anti_opt_out(t: Tables):
    refused = t.customer.filter("c_acctbal < 0")
    return lookups.exclude_if_in(t.orders.select("o_orderkey", "o_custkey"), refused, {"o_custkey": "c_custkey"})


@query(
    "audit_exclusions",
    """
    SELECT count(*) FILTER (WHERE p_size IN (7, 17, 21)) AS sensitive_study,
           count(*) FILTER (WHERE p_name LIKE '%ring%') AS sensitive_name,
           count(*) FILTER (WHERE s_nationkey = 3) AS excluded_region, count(*) AS rows
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    """,
)
def audit_exclusions(t: Tables):
    from ..operators.totals import leak_audit

    rows = t.lineitem.select("l_partkey", "l_suppkey").join(
        t.part.selectExpr("p_partkey AS l_partkey", "p_size", "p_name"), ["l_partkey"]
    ).join(t.supplier.selectExpr("s_suppkey AS l_suppkey", "s_nationkey"), ["l_suppkey"])
    return leak_audit(
        rows,
        {
            "sensitive_study": F.col("p_size").isin(list(CODES)),
            "sensitive_name": F.col("p_name").contains(NAME_PART),
            "excluded_region": F.col("s_nationkey") == 3,
            "rows": F.lit(True),
        },
    )
