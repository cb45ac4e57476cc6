"""Field formats, each over a whole table, on derived text with noise and nulls."""

import datetime as dt

from pyspark.sql import functions as F

from ..functions import dates, numbers, text
from ..functions.fixed_values import (
    ALNUM_ONLY,
    CASH_METHODS,
    DATE_PATTERN,
    GOVERNMENT_PLAN_PARTS,
    MEMBER_KEY_OFFSET,
    PRESCRIPTION_KEY_OFFSET,
    TIME_PATTERN,
)
from ..operators.lookups import attach_override
from ..plans.purchase_feed import feed_shape
from . import duck
from .registry import Tables, query

AS_OF = dt.date(2024, 1, 1)


def _sql(table: str, key: str, derived: dict[str, str], shown: dict[str, str]) -> str:
    """SELECT key, formats FROM (SELECT key, derived columns FROM table)."""
    inner = ", ".join([key, *(f"{e} AS {c}" for c, e in derived.items())])
    outer = ", ".join([key, *(f"{e} AS {c}" for c, e in shown.items())])
    return f"SELECT {outer} FROM (SELECT {inner} FROM {table})"


def _rows(t: Tables, table: str, key: str, derived: dict[str, str]):
    return getattr(t, table).selectExpr(*key.split(", "), *[f"{e} AS {c}" for c, e in derived.items()])


LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

NOISY = {
    "noisy": "CASE o_orderstatus WHEN 'P' THEN NULL ELSE '  #' || o_orderpriority || '@é/' || "
    "cast(o_custkey AS string) || '. x_' END"
}


@query(
    "fmt_clean",
    _sql("orders", "o_orderkey", NOISY, {
        "plain": duck.clean("noisy"), "strict": duck.clean("noisy", "[^0-9A-Za-z]"),
    }),
)
def fmt_clean(t: Tables):
    c = F.col("noisy")
    return _rows(t, "orders", "o_orderkey", NOISY).select(
        "o_orderkey", text.clean(c).alias("plain"), text.clean(c, ALNUM_ONLY).alias("strict")
    )


@query(
    "fmt_clean_pad",
    _sql("orders", "o_orderkey", NOISY, {
        "right12": duck.text("noisy", 12), "left20": duck.text("noisy", 20, "l", "0"),
        "untrimmed8": duck.text("noisy", 8, trim=None), "default7": duck.text("noisy", 7, null="PATIENT_ZIP"),
        "strict5": duck.text("noisy", 5, drop="[^0-9A-Za-z]"),
    }),
)
def fmt_clean_pad(t: Tables):
    c = F.col("noisy")
    return _rows(t, "orders", "o_orderkey", NOISY).select(
        "o_orderkey",
        text.clean_pad(c, 12).alias("right12"),
        text.clean_pad(c, 20, "left", "0").alias("left20"),
        text.clean_pad(c, 8, trim="none").alias("untrimmed8"),
        text.clean_pad(c, 7, null_text="PATIENT_ZIP").alias("default7"),
        text.clean_pad(c, 5, drop=ALNUM_ONLY).alias("strict5"),
    )


STAMPS = {
    "day": "CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN cast(cast(o_orderdate AS date) AS string) "
    "ELSE CASE WHEN o_custkey % 5 = 0 THEN 'no date' ELSE cast(cast(o_orderdate AS date) AS string) || ' 13:14:15' END END",
    "clock": "CASE o_orderstatus WHEN 'P' THEN NULL ELSE lpad(cast(o_custkey % 24 AS string), 2, '0') || ':' || "
    "lpad(cast(o_orderkey % 60 AS string), 2, '0') || ':07' END",
}


@query(
    "fmt_date_time",
    _sql("orders", "o_orderkey", STAMPS, {
        "day8": duck.date8("day"), "day10": duck.when_text("day", "%Y%m%d", 10, "r"), "time8": duck.time8("clock"),
    }),
)
def fmt_date_time(t: Tables):
    return _rows(t, "orders", "o_orderkey", STAMPS).select(
        "o_orderkey",
        dates.format_time(F.col("day"), DATE_PATTERN, 8).alias("day8"),
        dates.format_time(F.col("day"), DATE_PATTERN, 10, "right").alias("day10"),
        dates.format_time(F.col("clock"), TIME_PATTERN, 8).alias("time8"),
    )


KEYS = {
    "ref": "CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN cast(o_orderkey * 1000003 + 123456789012345 AS string) "
    "ELSE CASE o_custkey % 5 WHEN 0 THEN '#' || cast(o_orderkey AS string) WHEN 1 THEN 'none' "
    "ELSE cast(o_orderkey AS string) || '.75' END END"
}


@query(
    "fmt_offset_key",
    _sql("orders", "o_orderkey", KEYS, {
        "reference": "coalesce("
        + duck.grow(duck.offset(f"ltrim({duck.clean('ref')})", 152), 15, "l", "0") + ", repeat('0', 15))",
        "member": duck.spaces_if_null("ref", 20, duck.grow(duck.offset("trim(ref)", 845), 20)),
    }),
)
def fmt_offset_key(t: Tables):
    c = F.col("ref")
    member = numbers.offset_key(c, MEMBER_KEY_OFFSET, 20, "right", " ", cleaned=False)
    return _rows(t, "orders", "o_orderkey", KEYS).select(
        "o_orderkey",
        numbers.offset_key_or_zeros(c, PRESCRIPTION_KEY_OFFSET, 15).alias("reference"),
        F.when(c.isNull(), text.filler(20)).otherwise(member).alias("member"),
    )


HEX_KEYS = {"ref": "CASE o_orderstatus WHEN 'P' THEN NULL ELSE '#' || cast(o_orderkey * 98765432101 + 7 AS string) END"}


@query("fmt_hex_id", _sql("orders", "o_orderkey", HEX_KEYS, {"hex": duck.hex11("ref")}))
def fmt_hex_id(t: Tables):
    return _rows(t, "orders", "o_orderkey", HEX_KEYS).select(
        "o_orderkey", numbers.hex_id(F.col("ref"), 11).alias("hex")
    )


ORDINALS = {
    "n": "CASE l_linenumber WHEN 7 THEN NULL ELSE cast(cast(l_quantity AS int) * 3 - 9 AS string) || "
    "CASE l_linenumber WHEN 6 THEN '.5' ELSE '' END END"
}


@query(
    "fmt_clamp_ordinal",
    _sql("lineitem", LINE_KEY, ORDINALS, {"first": duck.ordinal("n", "NULL"), "second": duck.ordinal("n", "'00'")}),
)
def fmt_clamp_ordinal(t: Tables):
    return _rows(t, "lineitem", LINE_KEY, ORDINALS).select(
        *LINE_KEY.split(", "),
        numbers.clamp_ordinal(F.col("n")).alias("first"),
        numbers.clamp_ordinal(F.col("n"), "00").alias("second"),
    )


REFILLS = {"n": "CASE o_orderstatus WHEN 'P' THEN NULL ELSE cast(o_custkey - 120 AS string) || '.25' END"}


@query("fmt_clamp_abs", _sql("orders", "o_orderkey", REFILLS, {"refills": duck.clamp("n")}))
def fmt_clamp_abs(t: Tables):
    return _rows(t, "orders", "o_orderkey", REFILLS).select(
        "o_orderkey", numbers.clamp_abs(F.col("n")).alias("refills")
    )


AMOUNTS = {
    "amount": "CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN cast(l_partkey AS string) "
    "WHEN 5 THEN cast(cast(l_tax AS decimal(6,2)) AS string) WHEN 4 THEN '-' || cast(cast(l_discount AS decimal(6,2)) AS string) "
    "WHEN 3 THEN '-' || cast(cast(l_extendedprice AS decimal(12,2)) AS string) || '5' "
    "WHEN 2 THEN '12' || cast(cast(l_extendedprice AS decimal(12,2)) AS string) || '51' "
    "ELSE cast(cast(l_extendedprice AS decimal(12,2)) AS string) || '5' END",
    "flag": "CASE l_returnflag WHEN 'R' THEN 'Y' WHEN 'A' THEN 'N' END",
}


@query(
    "fmt_quantity",
    _sql("lineitem", LINE_KEY, AMOUNTS, {
        "blank_null": duck.quantity("amount", " "), "zero_null": duck.quantity("amount", "0"),
    }),
)
def fmt_quantity(t: Tables):
    c = F.col("amount")
    return _rows(t, "lineitem", LINE_KEY, AMOUNTS).select(
        *LINE_KEY.split(", "),
        numbers.quantity_or(c, " ").alias("blank_null"),
        numbers.quantity_or(c, "0").alias("zero_null"),
    )


@query("fmt_money", _sql("lineitem", LINE_KEY, AMOUNTS, {"money": duck.money_or_spaces("amount")}))
def fmt_money(t: Tables):
    return _rows(t, "lineitem", LINE_KEY, AMOUNTS).select(
        *LINE_KEY.split(", "), numbers.money_or_spaces(F.col("amount")).alias("money")
    )


@query("fmt_money_flagged", _sql("lineitem", LINE_KEY, AMOUNTS, {"money": duck.flagged_money("flag", "amount")}))
def fmt_money_flagged(t: Tables):
    return _rows(t, "lineitem", LINE_KEY, AMOUNTS).select(
        *LINE_KEY.split(", "), numbers.money_flagged(F.col("flag"), F.col("amount")).alias("money")
    )


CODED = {
    "code": "CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderstatus END",
    "method": "CASE o_custkey % 4 WHEN 0 THEN 'c' WHEN 1 THEN 'X' WHEN 2 THEN 'O' END",
    "plan": "CASE o_orderkey % 8 WHEN 0 THEN 'XXDPA' WHEN 1 THEN 'XXMED1' WHEN 2 THEN 'XXXPA' WHEN 3 THEN 'XXPA ' "
    "WHEN 4 THEN 'GAM' WHEN 5 THEN 'MAM9' WHEN 6 THEN 'OTHER' END",
}


@query(
    "fmt_code_map",
    _sql("orders", "o_orderkey", CODED, {
        "with_null": "CASE code WHEN 'O' THEN '1' WHEN 'F' THEN '2' ELSE CASE WHEN code IS NULL THEN '9' ELSE ' ' END END",
        "with_default": "CASE code WHEN 'O' THEN '01' ELSE '  ' END",
        "payment": "CASE WHEN upper(method) IN ('C', 'O') THEN '1' WHEN plan[3:5] IN ('DPA', 'MED', 'PA ') "
        "OR plan[4:5] = 'PA' OR plan[1:3] IN ('GAM', 'MAM') THEN '2' ELSE '3' END",
    }),
)
def fmt_code_map(t: Tables):
    cash = F.coalesce(text.in_any_case(F.col("method"), CASH_METHODS), F.lit(False))
    government = text.has_text_at(F.col("plan"), GOVERNMENT_PLAN_PARTS)
    return _rows(t, "orders", "o_orderkey", CODED).select(
        "o_orderkey",
        text.code_map(F.col("code"), {"O": "1", "F": "2"}, default=" ", null_code="9").alias("with_null"),
        text.code_map(F.col("code"), {"O": "01"}, default="  ").alias("with_default"),
        F.when(cash, "1").when(government, "2").otherwise("3").alias("payment"),
    )


@query(
    "fmt_presence",
    _sql("orders", "o_orderkey", CODED, {"present": "CASE WHEN code IS NULL THEN 'N' ELSE 'Y' END"}),
)
def fmt_presence(t: Tables):
    return _rows(t, "orders", "o_orderkey", CODED).select(
        "o_orderkey", text.presence_flag(F.col("code"), "N", "Y").alias("present")
    )


BLANKS = {
    "code": "CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '' ELSE ' #' || substr(o_orderpriority, 1, 1) END"
}


@query(
    "fmt_default_blank",
    _sql("orders", "o_orderkey", BLANKS, {
        "null_only": duck.bare("code", "0"), "blank_too": duck.bare("code", "00", blank_too=True),
        "trim_first": duck.bare("code", "00", blank_too=True, trim_first=True),
    }),
)
def fmt_default_blank(t: Tables):
    c = F.col("code")
    return _rows(t, "orders", "o_orderkey", BLANKS).select(
        "o_orderkey",
        text.default_if_blank(c, "0", blank_too=False).alias("null_only"),
        text.default_if_blank(c, "00").alias("blank_too"),
        text.default_if_blank(c, "00", trim_first=True).alias("trim_first"),
    )


PRODUCTS = {
    "compound": "CASE p_size % 3 WHEN 0 THEN 'C' WHEN 1 THEN '' END",
    "ndc": "CASE p_size % 4 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '##' ELSE lpad(cast(p_partkey AS string), 11, '0') END",
}


@query(
    "fmt_product_qualifier",
    "SELECT p_partkey, code, CASE WHEN trim(code) <> '' THEN 'N ' ELSE 'Z ' END AS kind FROM ("
    + _sql("part", "p_partkey", PRODUCTS, {
        "code": "CASE WHEN coalesce(compound, '') = '' AND ndc IS NOT NULL THEN "
        + duck.text("ndc", 19, null=None) + " ELSE repeat(' ', 19) END",
    })
    + ")",
)
def fmt_product_qualifier(t: Tables):
    code = text.product_code(F.col("compound"), F.col("ndc"), 19)
    return _rows(t, "part", "p_partkey", PRODUCTS).select(
        "p_partkey",
        code.alias("code"),
        text.product_code_kind(code).alias("kind"),
    )


STORE = {"store": "lpad(cast(l_suppkey AS string), 5, '0')", "zip": "'6' || lpad(cast(l_partkey % 10000 AS string), 4, '0')"}


@query(
    "fmt_override",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, store,
      CASE store WHEN '00011' THEN '00918' WHEN '00016' THEN '08628' ELSE zip END AS listed,
      coalesce(v.fixed, zip) AS zip
    FROM (SELECT {LINE_KEY}, {STORE['store']} AS store, {STORE['zip']} AS zip FROM lineitem)
    LEFT JOIN (SELECT s_suppkey, 'N' || cast(s_nationkey AS string) AS fixed FROM supplier WHERE s_acctbal < 0) v
      ON l_suppkey = s_suppkey
    """,
)
def fmt_override(t: Tables):
    rows = _rows(t, "lineitem", LINE_KEY, STORE)
    listed = text.override_by_key(F.col("store"), {"00011": "00918", "00016": "08628"}, F.col("zip"))
    fixed = t.supplier.filter("s_acctbal < 0").selectExpr("s_suppkey", "'N' || cast(s_nationkey AS string) AS fixed")
    return attach_override(rows.withColumn("listed", listed), fixed, {"l_suppkey": "s_suppkey"}, "fixed", "zip")


CASTS = {
    "n": "CASE l_linenumber WHEN 1 THEN 'x' WHEN 2 THEN '12.9' ELSE cast(cast(l_quantity AS int) AS string) END",
    "price": "cast(cast(l_extendedprice AS decimal(12,2)) AS string)",
    "day": "CASE l_linenumber WHEN 3 THEN 'soon' ELSE cast(cast(l_shipdate AS date) AS string) END",
}


@query(
    "prj_casts",
    _sql("lineitem", LINE_KEY, CASTS, {
        "whole": f"cast(trunc({duck.number('n')}) AS INTEGER)", "price": "try_cast(price AS DOUBLE)",
        "day": "try_cast(day AS DATE)", "key_text": "cast(l_orderkey AS VARCHAR)",
    }),
)
def prj_casts(t: Tables):
    return _rows(t, "lineitem", LINE_KEY, CASTS).select(
        *LINE_KEY.split(", "),
        numbers.to_integer(F.col("n")).alias("whole"),
        F.col("price").try_cast("double").alias("price"),
        F.col("day").try_cast("date").alias("day"),
        F.col("l_orderkey").cast("string").alias("key_text"),
    )


NODE = {"node": "'HIER0000' || CASE WHEN p_size = 9 THEN 'abc' ELSE lpad(cast(p_size AS string), 3, '0') END || 'Z'"}


@query(
    "prj_substring_code",
    _sql("part", "p_partkey", NODE, {"study": "try_cast(node[9:11] AS INTEGER)"}),
)
def prj_substring_code(t: Tables):
    return _rows(t, "part", "p_partkey", NODE).select(
        "p_partkey", numbers.to_integer(F.substring("node", 9, 3)).alias("study")
    )


@query(
    "prj_feed_shape",
    "SELECT DISTINCT cast(o_custkey AS VARCHAR) AS user_id, l_orderkey AS event_id, cast(l_quantity AS BIGINT) AS event_item_quantity, "
    "p_brand AS event_item_id, cast(l_extendedprice AS DECIMAL(18,2)) AS event_item_price, "
    "cast(o_orderdate AS DATE) AS event_timestamp, l_suppkey AS store_id "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
)
def prj_feed_shape(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    items = joined.selectExpr(
        "cast(o_custkey AS string) AS ECOMM_ID", "l_orderkey AS RFN", "cast(l_quantity AS bigint) AS QTY", "p_brand AS SKU_ID",
        "cast(l_extendedprice AS decimal(18,2)) AS PRICE", "date_format(o_orderdate, 'yyyyMMdd') AS SALES_TXN_DT",
        "l_suppkey AS STORE_NBR",
    )
    return feed_shape(items).withColumn("event_timestamp", F.col("event_timestamp").cast("date"))
