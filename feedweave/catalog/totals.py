"""Deduplication, totals, control counts, run state."""

from pyspark.sql import functions as F

from ..operators import quality, state
from ..operators import totals as ops
from ..operators.dedupe import dedupe_keys, latest_per_key
from ..session import scratch_path
from .registry import Tables, query


@query("dedup_rows", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_rows(t: Tables):
    return t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "dedup_keys",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price, qty FROM (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_extendedprice AS DECIMAL(18,2)) AS price,
        cast(l_quantity AS BIGINT) AS qty,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_partkey, l_suppkey, cast(l_extendedprice AS DECIMAL(18,2)), cast(l_quantity AS BIGINT)) AS n
      FROM lineitem) WHERE n = 1
    """,
)
def dedup_keys(t: Tables):
    rows = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "cast(l_extendedprice AS decimal(18,2)) AS price", "cast(l_quantity AS bigint) AS qty",
    )
    return dedupe_keys(rows, ["l_orderkey", "l_linenumber"])


@query(
    "agg_quantity",
    "SELECT l_orderkey, l_partkey, l_suppkey, cast(l_extendedprice AS DECIMAL(18,2)) AS price, l_returnflag, "
    "cast(sum(cast(l_quantity AS BIGINT)) AS BIGINT) AS qty FROM lineitem GROUP BY ALL",
)
def agg_quantity(t: Tables):
    rows = t.lineitem.selectExpr(
        "l_orderkey", "l_partkey", "l_suppkey", "cast(l_extendedprice AS decimal(18,2)) AS price",
        "l_returnflag", "cast(l_quantity AS bigint) AS units",
    )
    return ops.sum_by(rows, ["l_orderkey", "l_partkey", "l_suppkey", "price", "l_returnflag"], "units", "qty")


@query(
    "agg_broadcast_back",
    """
    SELECT DISTINCT l_partkey, l_suppkey, l_returnflag, l_linestatus, cast(sum(cast(l_quantity AS BIGINT))
      OVER (PARTITION BY l_partkey, l_suppkey) AS BIGINT) AS qty FROM lineitem
    """,
)
def agg_broadcast_back(t: Tables):
    rows = t.lineitem.selectExpr(
        "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "cast(l_quantity AS bigint) AS units"
    )
    return ops.total_per_group(rows, ["l_partkey", "l_suppkey"], "units", "qty")


def _daily(t: Tables):
    days = t.orders.selectExpr("o_orderkey", "cast(o_orderdate AS date) AS day")
    return t.lineitem.join(days, F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    "daily_revenue",
    """
    SELECT cast(o_orderdate AS DATE) AS day, count(*) AS count,
      sum(cast(l_quantity AS DECIMAL(12,0)) * cast(l_extendedprice AS DECIMAL(18,2)))::DECIMAL(38,2) AS total_sum
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
    """,
)
def daily_revenue(t: Tables):
    return ops.daily_revenue(_daily(t), "day", "l_quantity", "l_extendedprice")


@query(
    "daily_distinct_events",
    "SELECT cast(o_orderdate AS DATE) AS day, count(DISTINCT l_orderkey) AS events "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 1",
)
def daily_distinct_events(t: Tables):
    return ops.daily_distinct(_daily(t), "day", "l_orderkey", "events")


@query(
    "daily_events",
    "SELECT cast(o_orderdate AS DATE) AS day, count(*) AS count "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
)
def daily_events(t: Tables):
    return ops.daily_count(_daily(t), "day")


@query(
    "latest_per_key",
    """
    SELECT user_id, event_type, event_id, ts::VARCHAR AS ts FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events)
    WHERE n = 1
    """,
)
def latest_per_key_query(t: Tables):
    rows = t.events.select("user_id", "event_type", "event_id", "ts")
    newest = latest_per_key(rows, ["user_id"], "ts", ["event_id"])
    return newest.withColumn("ts", F.col("ts").cast("string"))


# a file per order priority; a line's status from its values
STATUS = (
    "CASE WHEN l_quantity > 45 THEN 'plan_excluded' WHEN l_quantity > 40 THEN 'term_excluded' "
    "WHEN l_quantity <= length(o_orderpriority) - 5 THEN 'reject' ELSE 'valid' END"
)
COUNTED = f"""
    SELECT o_orderpriority AS extract_file, count(*) AS total,
      count(*) FILTER (WHERE status = 'plan_excluded') AS plan_excluded,
      count(*) FILTER (WHERE status = 'term_excluded') AS term_excluded,
      count(*) FILTER (WHERE status = 'valid') AS valid, count(*) FILTER (WHERE status = 'reject') AS rejected
    FROM (SELECT o_orderpriority, {STATUS} AS status FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    GROUP BY 1
"""
NAMES = {
    "plan_excluded": "plan_excluded", "term_excluded": "term_excluded", "valid": "valid", "reject": "rejected",
}


def _counted(t: Tables):
    keyed = t.orders.select("o_orderkey", "o_orderpriority")
    rows = t.lineitem.select("l_orderkey", "l_quantity").join(keyed, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.selectExpr("o_orderpriority AS extract_file", f"{STATUS} AS status")
    return quality.control_totals(rows, ["extract_file"], "status", NAMES)


@query("quality_counts", COUNTED)
def quality_counts(t: Tables):
    return _counted(t)


@query(
    "quality_gate",
    f"""
    SELECT *, rejected * 100.0::DOUBLE / (valid + rejected) AS reject_pct,
      CASE WHEN valid + rejected = 0 THEN 'empty' WHEN rejected * 100.0::DOUBLE / (valid + rejected) > 5 THEN 'stop'
           WHEN rejected = 0 THEN 'clean' ELSE 'with_rejects' END AS decision
    FROM (SELECT *, valid + rejected AS formatted FROM ({COUNTED}))
    """,
)
def quality_gate(t: Tables):
    counted = _counted(t).withColumn("formatted", F.col("valid") + F.col("rejected"))
    return quality.gate(counted, "rejected", "formatted", 5.0)


# run state: one extract per order, its row count from the lines
STATE = """
    SELECT o_orderpriority AS extract_name, 'landing/' || cast(o_orderkey AS string) || '.dat' AS extract_landing_path,
      CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS extract_landing_flag,
      CASE WHEN o_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS extract_prcsd_flag,
      'N' AS transformation_complition_flag, 'N' AS deid_complition_flag, 'N' AS transformed_file_deletion_flag,
      coalesce(lines, 0) AS master_straight_record_count
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
"""


def _state(t: Tables):
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    rows = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.selectExpr(
        "o_orderpriority AS extract_name",
        "'landing/' || cast(o_orderkey AS string) || '.dat' AS extract_landing_path",
        "CASE WHEN o_orderstatus = 'P' THEN 'N' ELSE 'Y' END AS extract_landing_flag",
        "CASE WHEN o_custkey % 4 = 0 THEN 'Y' ELSE 'N' END AS extract_prcsd_flag",
        "'N' AS transformation_complition_flag", "'N' AS deid_complition_flag",
        "'N' AS transformed_file_deletion_flag", "coalesce(lines, 0) AS master_straight_record_count",
    )


@query(
    "state_pending",
    f"SELECT extract_landing_path, master_straight_record_count FROM ({STATE}) WHERE extract_name = '2-HIGH' "
    "AND extract_landing_flag = 'Y' AND extract_prcsd_flag = 'N' AND master_straight_record_count > 0",
)
def state_pending(t: Tables):
    return state.pending_work(_state(t), "2-HIGH").select("extract_landing_path", "master_straight_record_count")


@query(
    "state_upsert",
    f"""
    SELECT extract_name, extract_landing_path, extract_prcsd_flag,
      CASE WHEN touched THEN 'Y' ELSE transformation_complition_flag END AS transformation_complition_flag,
      CASE WHEN touched AND o_custkey % 3 <> 0 THEN o_custkey ELSE master_straight_record_count END
        AS master_straight_record_count
    FROM (SELECT *, o_orderstatus = 'O' AND extract_landing_flag = 'Y' AND extract_prcsd_flag = 'N' AS touched
      FROM ({STATE}) JOIN (SELECT 'landing/' || cast(o_orderkey AS string) || '.dat' AS path, o_custkey,
        o_orderstatus FROM orders) ON path = extract_landing_path)
    """,
)
def state_upsert(t: Tables):
    changes = t.orders.filter("o_orderstatus = 'O'").selectExpr(
        "o_orderpriority AS extract_name",
        "'landing/' || cast(o_orderkey AS string) || '.dat' AS extract_landing_path",
        "'Y' AS transformation_complition_flag",
        "CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS master_straight_record_count",
    )
    root = scratch_path(t.spark, "state")
    state.write_state(t.spark, _state(t), root)
    # two commits, the second on top of the first; processed rows with the same key keep their values
    state.commit_changes(t.spark, changes.filter("extract_name < '3'"), root)
    state.commit_changes(t.spark, changes.filter("extract_name >= '3'"), root)
    return state.read_state(t.spark, root).select(
        "extract_name", "extract_landing_path", "extract_prcsd_flag", "transformation_complition_flag",
        "master_straight_record_count",
    )
