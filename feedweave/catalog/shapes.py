"""The source shapes of the three feeds, derived from the test tables.

Every expression below is valid both in Spark and in DuckDB, so each shape is
stated once and both engines derive the same rows from the same tables.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..session import scratch_path, stored
from ..sources.storage import Store
from .registry import Tables

# --- purchase feed ---------------------------------------------------------

# sensitive codes, name part and region used with the test tables
CODES = (7, 17, 21)
NAME_PART = "ring"
REGION = 3


# the sales that each filter of the feed is there for
KEPT_SALES = "l_quantity NOT IN (13, 15) AND l_orderkey % 17 <> 0 AND l_orderkey % 23 <> 0 AND o_custkey % 19 <> 0"
# Item lines whose headers one task makes distinct.
HEADER_ROWS = 500_000


def sales(t: Tables) -> DataFrame:
    """Item lines, and a loyalty header, twice, for each order and store.

    Some lines have negative quantities or another record type, some transactions no
    id, no loyalty id, or a date that does not exist.
    """
    day = "CASE WHEN l_orderkey % 23 = 0 THEN '19960231' ELSE date_format(o_orderdate, 'yyyyMMdd') END AS SALES_TXN_DT"
    both = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "CASE WHEN l_orderkey % 17 = 0 THEN ' ' ELSE cast(l_orderkey AS string) END AS RFN", day, "cast(l_suppkey AS string) AS STORE_NBR",
        "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "CASE WHEN o_custkey % 19 = 0 THEN ' ' ELSE cast(o_custkey AS string) END AS loyalty_id",
    )
    lines = both.selectExpr(
        "CASE WHEN l_quantity = 15 THEN 1200 ELSE 1100 END AS RECORDTYP", "RFN", "SALES_TXN_DT", "STORE_NBR", "cast(l_partkey AS string) AS UPC_NBR",
        "cast(l_partkey AS string) AS ARTICLE_NBR", "cast(l_linenumber AS string) AS LINE_ITEM_SEQ_NBR",
        "cast(CASE WHEN l_quantity = 13 THEN -l_quantity ELSE l_quantity END AS string) AS UNIT_QTY", "l_extendedprice AS ITEM_UNIT_PRICE_DLRS", "'' AS loyalty_id",
    )
    # nearly as many headers as lines: dealt over all partitions, which adaptive execution would merge by their compressed
    # size, and over more of them as the table grows; made distinct once for both copies
    keys = ["RFN", "SALES_TXN_DT", "STORE_NBR", "loyalty_id"]
    parts = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // HEADER_ROWS))
    twice = both.select(*keys).repartition(parts, *keys).distinct().withColumn("__copy", F.explode(F.array(F.lit(0), F.lit(1))))
    headers = twice.selectExpr(
        "1000 AS RECORDTYP", "RFN", "SALES_TXN_DT", "STORE_NBR", "cast(NULL AS string) AS UPC_NBR",
        "cast(NULL AS string) AS ARTICLE_NBR", "cast(NULL AS string) AS LINE_ITEM_SEQ_NBR",
        "cast(NULL AS string) AS UNIT_QTY", "cast(NULL AS double) AS ITEM_UNIT_PRICE_DLRS", "loyalty_id",
    )
    return lines.unionByName(headers)


def identity(t: Tables) -> DataFrame:
    """Loyalty ids from customers, online ids from purchase events of the same person.

    Every customer also has a closed row under another person, other events are closed
    online rows, and open rows of another source.
    """
    rows = ["{0} AS mid", "'{1}' AS cust_src_cd", "{2} AS cust_src_id", "{3} AS dna_update_dttm", "'{4} 00:00:00' AS dna_end_dttm"]
    shape = lambda *values: [r.format(*values) for r in rows]
    new, open_, closed = "timestamp_ntz'2024-01-01 00:00:00'", "9999-12-31", "2001-01-01"
    other = t.events.filter("event_type <> 'purchase'")
    parts = [
        t.customer.selectExpr(*shape("c_custkey", "LR", "cast(c_custkey AS string)", new, open_)),
        t.customer.selectExpr(*shape("c_custkey + 1", "LR", "cast(c_custkey AS string)", new, closed)),
        t.events.filter("event_type = 'purchase'").selectExpr(*shape("user_id", "EC", "cast(event_id AS string)", "ts", open_)),
        other.selectExpr(*shape("user_id", "EC", "cast(event_id AS string)", new, closed)),
        other.selectExpr(*shape("user_id", "ZZ", "cast(event_id AS string)", new, open_)),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- claims ----------------------------------------------------------------

CLAIM_FROM = """
lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
"""


def _text(c):
    return f"cast({c} AS string)"


def _digits(c, n):
    return f"lpad({_text(c)}, {n}, '0')"


def _without(c, quantity):
    """Null for one value of the quantity, so that every null branch is met."""
    return f"CASE WHEN l_quantity = {quantity} THEN NULL ELSE {c} END"


def _day(c):
    return f"cast(cast({c} AS date) AS string)"


def _clock(hour, minute, second):
    return (
        f"{_digits(f'({hour}) % 24', 2)} || ':' || {_digits(f'({minute}) % 60', 2)} || ':' || "
        f"{_digits(f'({second}) % 60', 2)}"
    )


def _amount(c):
    return f"cast(cast({c} AS decimal(12,2)) AS string)"


_STORE = (
    f"CASE l_suppkey % 7 WHEN 0 THEN '09599' WHEN 1 THEN '03397' WHEN 2 THEN '11847' WHEN 3 THEN '16034' "
    f"ELSE {_digits('l_suppkey', 5)} END"
)
_PLAN = (
    "CASE p_size % 7 WHEN 0 THEN 'XXDPA1' WHEN 1 THEN 'XXMED' WHEN 2 THEN 'XXXPA' WHEN 3 THEN 'GAM01' "
    "WHEN 4 THEN 'MAM' WHEN 5 THEN 'PLAN#9' END"
)
_GROUP = f"'G-' || {_text('l_suppkey % 10')} || '#'"
STATES = "CASE {} % 6 WHEN 0 THEN 'WI' WHEN 1 THEN 'mn' WHEN 2 THEN 'IL' WHEN 3 THEN 'WA' WHEN 4 THEN 'TX' ELSE 'CA' END"

# Claim column -> expression over the joined tables.
CLAIM_COLUMNS = {
    "extract_file": "'/landing/claims_' || substr(o_orderpriority, 1, 1) || '.dat'",
    "relocate_fm_str_nbr": _without(_digits("l_suppkey", 5), 50),
    "str_nbr": _without(_STORE, 49),
    "rx_nbr": _without(_text("l_orderkey * 1000 + l_linenumber"), 48),
    "rx_fill_nbr": _text("l_linenumber"),
    "fill_enter_dt": _without(_day("o_orderdate"), 47),
    "fill_enter_tm": _clock("l_partkey", "l_orderkey", "l_suppkey"),
    "fill_sold_dt": _day("l_shipdate"),
    "fill_sold_tm": _without(_clock("l_orderkey", "l_suppkey", "l_partkey"), 47),
    "pat_id": _without(_text("1000000 + o_custkey"), 43),
    "fill_stat_cd": "' ' || l_returnflag",
    "dspn_fill_nbr": _without(_text("cast(l_quantity AS int) * 3 - 5"), 42),
    "fill_qty_dspn": _without(_amount("l_extendedprice"), 41),
    "fill_days_supply": _without(_text("p_size"), 40),
    "fill_type_cd": _without("l_returnflag", 39),
    "partial_fill_cd": _without("l_linestatus", 38),
    "fill_vrfy_dt": _day("l_shipdate"),
    "fill_vrfy_tm": _clock("l_suppkey", "l_suppkey", "l_suppkey"),
    "fill_data_review_dt": _without(_day("o_orderdate"), 37),
    "fill_data_review_tm": _clock("p_size", "p_size", "p_size"),
    "filling_dt": _day("o_orderdate"),
    "filling_tm": _clock("l_partkey", "l_partkey", "l_partkey"),
    "fill_del_dt": "CASE WHEN l_returnflag = 'R' THEN " + _day("l_shipdate") + " END",
    "fill_del_tm": "CASE WHEN l_returnflag = 'R' THEN " + _clock("l_orderkey", "l_orderkey", "1") + " END",
    "return_plan_id": "'P_' || " + _text("s_nationkey"),
    "cob_ind": "CASE l_linenumber % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "fill_adjud_cd": "l_linestatus",
    "fill_adjud_dt": _day("l_shipdate"),
    "fill_adjud_tm": _clock("o_custkey", "o_custkey", "o_custkey"),
    "general_recipient_nbr": _without("'R*' || " + _text("o_custkey"), 36),
    "plan_group_nbr": _GROUP,
    "plan_submit_cost_dlrs": "CASE WHEN l_quantity = 46 THEN '1234567.10' ELSE " + _amount("l_extendedprice") + " END",
    "plan_submit_fee_dlrs": "CASE WHEN l_quantity = 45 THEN '-0.55' ELSE " + _amount("l_discount") + " END",
    "bin_nbr": _digits("s_suppkey", 4),
    "reject_cd_1": "'7' || l_returnflag",
    "reject_cd_2": _without("'85'", 34),
    "reject_cd_3": "cast(NULL AS string)",
    "max_reject_nbr": _text("l_linenumber"),
    "rx_written_dt": _day("o_orderdate"),
    "fill_nbr_prescribed": _without(_text("o_custkey % 150 - 20"), 33),
    "rx_orig_qty": _without(_text("cast(l_quantity AS int)"), 32),
    "drug_non_sys_cd": "CASE p_size % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'C' WHEN 2 THEN '' END",
    "rx_daw_cd": "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN '1' END",
    "prcs_ctrl_nbr": "p_brand",
    "fill_sold_dlrs": _without(_amount("o_totalprice"), 31),
    "origin_cd": _without(_text("l_linenumber"), 30),
    "diagnosis_cd_1": "p_type || ' (' || " + _text("p_size") + " || ')'",
    "diagnosis_cd_qlfr": "CASE l_linenumber % 3 WHEN 0 THEN '' WHEN 1 THEN ' 02' END",
    "free_goods_ind": "CASE WHEN l_quantity = 44 THEN NULL WHEN p_size % 5 = 0 THEN 'Y' ELSE 'N' END",
    "plan_copay_dlrs": _without(_amount("l_tax"), 29),
    "benefit_stg_1_qlfr_cd": "CASE WHEN l_linenumber % 2 = 0 THEN '1' END",
    "basis_of_reimb_detrm": "CASE l_linenumber % 3 WHEN 0 THEN ' 7 ' WHEN 1 THEN '12' END",
    "fill_awp_cost_dlrs": _without(_amount("l_extendedprice"), 28),
    "plan_return_copay_dlrs": _without(_amount("c_acctbal"), 27),
    "fill_pay_method_cd": "CASE o_orderstatus WHEN 'P' THEN 'c' WHEN 'F' THEN 'X' END",
    "third_party_plan_id": _PLAN,
    "ntwrk_remb_return_id": "c_mktsegment",
    "relation_cd_pit": _without(_text("c_nationkey % 5"), 26),
    "pat_first_name_pit": _without("substr(c_name, 1, 8)", 25),
    "pat_last_name_pit": _without("c_name", 24),
    "pat_brth_dt_pit": _without("cast(cast(o_orderdate AS date) - INTERVAL '83' YEAR AS string)", 23),
    "pat_gndr_cd_pit": "CASE c_nationkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END",
    "pat_address_line_pit": _without("'12/' || c_name || ' [unit]'", 22),
    "pat_state_cd_pit": STATES.format("c_nationkey"),
    "pat_zip_cd_5_pit": _without(_digits("o_custkey * 37 % 100000", 5), 21),
    "eid_cur": _without(_text("o_custkey + 5000000"), 20),
    "pbr_dea_nbr": _without("'B-' || " + _text("s_suppkey"), 19),
    "pbr_state_cd_pit": _without(STATES.format("s_nationkey"), 18),
    "pbr_last_name_pit": "s_name",
    "pbr_npi_pit": _digits("s_suppkey", 10),
    "pbr_first_name_pit": "substr(s_name, 1, 8)",
    "pbr_middle_initial_pit": "substr(s_name, 2, 1)",
    "pbr_city_pit": "'City ' || " + _text("s_nationkey"),
    "pbr_zip_cd_5_pit": _digits("s_suppkey", 5),
    "ndc11_cur": "CASE p_size % 3 WHEN 0 THEN " + _digits("p_partkey", 11) + " WHEN 1 THEN '' END",
    "pkg_sz_uom_cur": "'EA'",
    "prod_name_cur": "CASE p_size WHEN 1 THEN NULL WHEN 2 THEN '' ELSE p_name END",
    "store_nabp_nbr_cur": _without(_digits("s_suppkey", 7), 17),
    "ldb_store_type_cur": "CASE s_nationkey % 3 WHEN 0 THEN '04' WHEN 1 THEN '01' END",
    "store_zip_cd_5": "CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '   ' ELSE " + _digits("s_suppkey", 4) + " END",
    "store_npi_nbr_cur": _digits("s_suppkey", 10),
    "benefit_stg_2_qlfr_cd": "CASE WHEN l_linenumber % 3 = 0 THEN '02' END",
    "benefit_stg_3_qlfr_cd": "cast(NULL AS string)",
    "benefit_stg_4_qlfr_cd": "'4'",
    "fill_rtl_price_dlrs": _without(_amount("p_retailprice"), 16),
    "return_plan_group_nbr": "' ' || p_brand",
    "generic_prod_id_cur": _text("p_size"),
}

@dataclass(frozen=True)
class Shape:
    """A selection from one table, as a DataFrame and as SQL."""

    table: str
    columns: dict[str, str]
    where: str = "TRUE"

    def df(self, t: Tables) -> DataFrame:
        chosen = [f"{e} AS {c}" for c, e in self.columns.items()]
        return getattr(t, self.table).filter(self.where).selectExpr(*chosen)

    @property
    def sql(self) -> str:
        chosen = ", ".join(f"{e} AS {c}" for c, e in self.columns.items())
        return f"SELECT {chosen} FROM {self.table} WHERE {self.where}"


# Lookups of the extract, over the test tables.
CUSTOMER_ZIP = _digits("c_custkey * 37 % 100000", 5)
SUPPLIER_GROUP = f"'G-' || {_text('s_suppkey % 10')} || '#'"
ZIP_SUPPRESS = Shape(
    "customer",
    {"STATE_CD": STATES.format("c_nationkey"), "zip_3": f"substr({CUSTOMER_ZIP}, 1, 3)"},
    "c_acctbal < 0",
)
EXCLUDED_PLANS = Shape(
    "supplier", {"THIRD_PARTY_PLAN_ID": "'GAM01'", "PLAN_GROUP_NBR": SUPPLIER_GROUP}, "s_nationkey = 3"
)
FREE_GOODS_PLANS = Shape(
    "supplier", {"THIRD_PARTY_PLAN_ID": "'XXMED'", "PLAN_GROUP_NBR": SUPPLIER_GROUP}, "s_nationkey IN (4, 5, 6)"
)
FREE_GOODS_PRODUCTS = Shape("part", {"GENERIC_PROD_ID": _text("p_size")}, "p_brand = 'Brand#5'")
TERMS = ("ring", "cold g")


def claim_sql(columns=None) -> str:
    chosen = columns or list(CLAIM_COLUMNS)
    return f"SELECT {', '.join(f'{CLAIM_COLUMNS[c]} AS {c}' for c in chosen)} FROM {CLAIM_FROM}"


def _for_claims(df: DataFrame, *keys: str) -> DataFrame:
    """The columns that claims are made of, and the keys of the join to come."""
    named = set(re.findall(r"\w+", " ".join(CLAIM_COLUMNS.values())))
    return df.select(*[c for c in df.columns if c in named or c in keys])


def claim_rows(t: Tables) -> DataFrame:
    """The narrow rows that claims are made of.

    Item lines are shuffled by part, where parts are many, before they carry anything, and once by order. That shuffle also
    spreads them (the test files hold one row group each); a further one, of whole rows, would be the largest of all.
    Orders meet their customers apart, before they meet their lines, and are stored so that Spark knows their size.
    """
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    placed = stored(_for_claims(placed, "o_orderkey"), "orders")
    parts = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        _for_claims(t.lineitem, "l_orderkey", "l_partkey", "l_suppkey")
        .join(_for_claims(t.part, "p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
        .repartition(parts, "l_orderkey")
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_for_claims(t.supplier, "s_suppkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    )


def claims(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """Claims as wide rows, of the given narrow rows or of those of the tables."""
    return (claim_rows(t) if rows is None else rows).selectExpr(*[f"{e} AS {c}" for c, e in CLAIM_COLUMNS.items()])


def add_file(t: Tables, folder: str, header: Sequence[str], lines: DataFrame, name: str = "damaged.dat") -> None:
    """One more file in a landing folder: a header and the given lines as they are."""
    store, place = Store(t.spark), scratch_path(t.spark, "lines")
    first = t.spark.createDataFrame([(0, fixed.FIELD_SEPARATOR.join(header))], "part int, line string")
    # a landing file is one file by contract, its header first
    both = first.union(lines.toDF("line").select(F.lit(1), "line"))
    both.repartition(1).sortWithinPartitions("part").select("line").write.text(place)
    (part,) = [n for n in store.names(place) if n.startswith("part-")]
    store.make(folder)
    store.move(f"{place}/{part}", f"{folder}/{name}")
