"""Sources and sinks: tables are written to the shared folder and read back."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.layout import REJECTED, layout_status
from ..session import scratch_path
from ..sources import readers, writers
from . import shapes
from .records import CHECKED, ORDER_LAYOUT, RECORD, _lines
from .registry import Tables, query


@query("src_table", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def src_table(t: Tables):
    return t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


# Orders whose line has lost a separator, or has one too many.
SHORT_LINE = "cast(o_orderkey AS string) || chr(1) || o_orderpriority"
LONG_LINE = "cast(o_orderkey AS string) || chr(1) || 'x' || chr(1) || o_orderpriority || chr(1) || 'more'"
DAMAGED = f"CASE o_orderkey % 50 WHEN 0 THEN {SHORT_LINE} WHEN 1 THEN {LONG_LINE} END"


@query(
    "src_delimited",
    f"""
    SELECT CASE WHEN line IS NULL THEN o_orderkey END AS o_orderkey, CASE WHEN line IS NULL THEN status END AS status,
      CASE WHEN line IS NULL THEN o_orderpriority END AS o_orderpriority, line
    FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority, {DAMAGED} AS line FROM orders)
    """,
)
def src_delimited(t: Tables):
    """Sound rows, and beside them the lines with more or fewer fields than the header, as they came."""
    path, columns = scratch_path(t.spark, "delimited"), ["o_orderkey", "status", "o_orderpriority"]
    rows = t.orders.selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS status", "o_orderpriority", f"{DAMAGED} AS line")
    writers.write_delimited(rows.filter("line IS NULL").select(*columns), path)
    shapes.add_file(t, path, columns, rows.filter("line IS NOT NULL").select("line"))
    sound, lines = readers.split_damaged(readers.read_delimited(t.spark, path, columns, damaged="line"), "line")
    both = sound.withColumn("line", F.lit(None).cast("string")).unionByName(
        lines.select(*[F.lit(None).cast("string").alias(c) for c in columns], "line")
    )
    return both.withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query("src_delimited_noquote", "SELECT cast(event_id AS VARCHAR) AS event_id, '\"' || props AS props FROM events")
def src_delimited_noquote(t: Tables):
    path = scratch_path(t.spark, "noquote")
    rows = t.events.selectExpr("cast(event_id AS string) AS event_id", "'\"' || props AS props")
    writers.write_delimited(rows, path, quote="")
    return readers.read_delimited(t.spark, path, quote="")


@query("src_lookup", "SELECT p_type, min(p_brand) AS p_brand FROM part WHERE p_size <> 5 GROUP BY p_type")
def src_lookup(t: Tables):
    path = scratch_path(t.spark, "lookup")
    rows = t.part.selectExpr("CASE WHEN p_size <> 5 THEN ' ' || p_type || ' ' END AS p_type", "p_brand")
    writers.write_delimited(rows, path, sep=",")
    return readers.read_lookup(t.spark, path, ["p_type"])


@query("snk_fixed_width", f"SELECT fixedlength AS value FROM ({RECORD})")
def snk_fixed_width(t: Tables):
    path = scratch_path(t.spark, "records")
    writers.write_fixed_width(ORDER_LAYOUT.record(_lines(t)), path)
    return t.spark.read.text(path)


@query(
    "snk_rejects",
    f"SELECT fixedlength, cast(strlen(fixedlength) AS INTEGER) AS encode FROM ({CHECKED}) WHERE NOT ok",
)
def snk_rejects(t: Tables):
    path = scratch_path(t.spark, "rejects")
    records = ORDER_LAYOUT.record(_lines(t)).withColumn("part", layout_status())
    writers.write_rejects(records.filter(F.col("part") == REJECTED).select("fixedlength", "encode"), path)
    back = readers.read_delimited(t.spark, path, ["fixedlength", "encode"], sep=",")
    return back.withColumn("encode", F.col("encode").cast("int"))


@query("snk_delimited", "SELECT cast(s_suppkey AS VARCHAR) AS s_suppkey, s_name || ',|\"x\"' AS s_name FROM supplier")
def snk_delimited(t: Tables):
    path = scratch_path(t.spark, "out")
    writers.write_delimited(t.supplier.selectExpr("s_suppkey", "s_name || ',|\"x\"' AS s_name"), path)
    return readers.read_delimited(t.spark, path).select("s_suppkey", "s_name")


@query("snk_pipe", "SELECT cast(p_partkey AS VARCHAR) AS p_partkey, p_name || '|' || p_type AS p_name FROM part")
def snk_pipe(t: Tables):
    path = scratch_path(t.spark, "pipe")
    writers.write_pipe(t.part.selectExpr("p_partkey", "p_name || '|' || p_type AS p_name"), path)
    return readers.read_delimited(t.spark, path, sep="|").select("p_partkey", "p_name")


def _code(*values: str) -> str:
    """A row's code in the manifest, as DuckDB SQL."""
    return " || ".join(f"coalesce(strlen({v}) || ':' || {v}, 'N')" for v in values)


def _lane(code: str, at: int) -> str:
    return f"sum(('0x' || substr(md5({code}), {at}, 16))::UBIGINT)::DECIMAL(38,0)"


LINE = _code(
    "cast(l_orderkey AS VARCHAR)", "cast(l_linenumber AS VARCHAR)", "cast(cast(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)",
    "nullif(l_returnflag, 'R')", "CASE WHEN l_returnflag = 'A' THEN '' ELSE l_linestatus || '|' END",
    "strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.000')",
)


@query(
    "snk_manifest",
    f"SELECT count(*) AS rows, count(*) + 1 AS rows_with_header, {_lane(LINE, 1)} AS checksum_1, {_lane(LINE, 17)} AS checksum_2 FROM lineitem",
)
def snk_manifest(t: Tables):
    path = scratch_path(t.spark, "manifest")
    rows = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "cast(l_extendedprice AS decimal(18,2)) AS price", "nullif(l_returnflag, 'R') AS flag",
        "CASE WHEN l_returnflag = 'A' THEN '  ' ELSE l_linestatus || '| ' END AS status", "cast(l_shipdate AS timestamp_ntz) AS shipped",
    )
    writers.write_with_manifest(t.spark, rows, path)
    back = t.spark.read.json(f"{path}_manifest")
    return back.select("rows", "rows_with_header", *[F.col(c).cast("decimal(38,0)").alias(c) for c in writers.CHECKSUMS])


@query(
    "snk_readback",
    """
    SELECT 'as written' AS what, count(*) AS expected, count(*) AS found, TRUE AS ok FROM customer
    UNION ALL SELECT 'a cell changed', count(*), count(*), FALSE FROM customer
    UNION ALL SELECT 'a separator moved', count(*), count(*), FALSE FROM customer
    UNION ALL SELECT 'a row twice, another lost', count(*), count(*), FALSE FROM customer
    """,
)
def snk_readback(t: Tables):
    """A folder compared with its own manifest, and with those of rows that differ from it a little."""
    path, columns = scratch_path(t.spark, "readback"), ["c_custkey", "name", "segment"]
    rows = t.customer.selectExpr(
        "c_custkey", "CASE WHEN c_nationkey = 5 THEN '' WHEN c_nationkey <> 6 THEN c_name || '|' END AS name", "c_mktsegment AS segment"
    )
    seen = writers.write_with_manifest(t.spark, rows, path)
    last = rows.agg(F.max("c_custkey").alias("last")).first()["last"]
    changes = {
        "a cell changed": F.struct("c_custkey", "name", F.when(F.col("c_custkey") == last, "other").otherwise(F.col("segment"))),
        "a separator moved": F.struct("c_custkey", F.rtrim("name", F.lit("|")), F.concat(F.lit("|"), "segment")),
        "a row twice, another lost": F.struct(F.when(F.col("c_custkey") == last, 1).otherwise(F.col("c_custkey")), "name", "segment"),
    }
    found = [writers.verify_written(t.spark, path, seen, columns).withColumn("what", F.lit("as written"))]
    for what, changed in changes.items():
        other = rows.select(changed.alias("r")).select("r.*").toDF(*columns)
        expected = writers.manifest(other).first().asDict()
        found.append(writers.verify_written(t.spark, path, expected, columns).withColumn("what", F.lit(what)))
    return reduce(DataFrame.unionByName, found)
