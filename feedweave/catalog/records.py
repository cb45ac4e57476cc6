"""Fixed-width records and the layout check, over a small layout of order lines."""

from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators.layout import REJECTED, Field, Layout, layout_status
from . import duck
from .registry import Tables, query

ORDER_LAYOUT = Layout(
    (
        Field("order", 15, ("o_orderkey",), lambda ctx, w, c: numbers.offset_key_or_zeros(c.cast("string"), 152, w), True),
        Field("status", 1, ("status",), lambda ctx, w, c: c, True),
        Field("priority", 8, ("o_orderpriority",), lambda ctx, w, c: text.clean_pad(c, w)),
        Field("blank", 3, (), lambda ctx, w: text.filler(w)),
        Field("kind", 2, (), lambda ctx, w: text.constant("12", w)),
        Field("total", 8, ("price",), lambda ctx, w, c: numbers.money_or_spaces(c), True),
        Field("units", 10, ("l_quantity",), lambda ctx, w, c: numbers.quantity_or(c, "0"), True),
    )
)
LINES = (
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority, l_linenumber, l_partkey, l_suppkey, "
    "cast(CASE WHEN l_quantity = 9 THEN l_extendedprice + 1000000 ELSE l_extendedprice END AS decimal(12,2)) AS price, "
    "cast(l_quantity AS int) AS l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)
RECORD = (
    f"SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, price, concat_ws('', lpad(cast(o_orderkey + 152 AS VARCHAR), 15, '0'), "
    f"status, {duck.text('o_orderpriority', 8)}, '   ', '12', {duck.money_or_spaces('price')}, "
    f"{duck.quantity('l_quantity', '0')}) AS fixedlength FROM ({LINES})"
)
KEY = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'P') AS status", "o_orderpriority", "l_linenumber", "l_partkey",
        "l_suppkey",
        "cast(CASE WHEN l_quantity = 9 THEN l_extendedprice + 1000000 ELSE l_extendedprice END AS decimal(12,2)) AS price",
        "cast(l_quantity AS int) AS l_quantity",
    )


@query(
    "fixed_width_record",
    f"SELECT * EXCLUDE (price), cast(strlen(fixedlength) AS INTEGER) AS encode, "
    f"strlen(fixedlength) = 47 AND price < 1000000 AS layout_ok FROM ({RECORD})",
)
def fixed_width_record(t: Tables):
    return ORDER_LAYOUT.record(_lines(t), carry=KEY)


CHECKED = f"SELECT fixedlength, strlen(fixedlength) = 47 AND price < 1000000 AS ok FROM ({RECORD})"


@query(
    "layout_split",
    f"""
    SELECT fixedlength, CASE WHEN ok THEN 'valid' ELSE 'reject' END AS part,
      CASE WHEN NOT ok THEN cast(strlen(fixedlength) AS INTEGER) END AS encode FROM ({CHECKED})
    """,
)
def layout_split(t: Tables):
    part = layout_status()
    return ORDER_LAYOUT.record(_lines(t)).select(
        "fixedlength", part.alias("part"), F.when(part == REJECTED, F.col("encode")).alias("encode")
    )
