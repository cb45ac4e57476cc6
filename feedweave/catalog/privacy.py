"""Privacy: generalised values, tokens, protection under keys drawn anew for each run."""

import secrets

from pyspark.sql import functions as F

from ..functions.dates import birth_year_topcode
from ..functions.privacy import KeyRing, base64_line, encode_base64, publish_token, tokenise, zip3_generalise
from ..functions.text import in_any_case, suppress_when
from ..operators.lookups import flag_if_in
from . import duck
from .formats import AS_OF, _rows, _sql
from .registry import Tables, query
from .shapes import CUSTOMER_ZIP, STATES, ZIP_SUPPRESS

SALT = "demonstration salt:"


def fresh_keys(*key_ids: str) -> KeyRing:
    return KeyRing({k: secrets.token_hex(16) for k in key_ids})


BIRTHS = {
    "born": "CASE o_orderstatus WHEN 'P' THEN NULL ELSE "
    "CASE WHEN o_custkey % 50 = 0 THEN 'unknown' ELSE cast(cast(o_orderdate AS date) - INTERVAL '64' YEAR AS string) END END"
}


def _birth_sql(oldest: int) -> str:
    day = "cast(try_cast(born AS TIMESTAMP) AS DATE)"
    age = f"cast(trunc(abs(date_diff('day', DATE '2024-01-01', {day})) / 365.25) AS INTEGER)"
    return (
        f"CASE WHEN born IS NULL THEN '    ' WHEN {age} > {oldest} THEN '0000' "
        f"ELSE cast(year({day}) AS VARCHAR) END"
    )


@query(
    "privacy_birth_year",
    _sql("orders", "o_orderkey", BIRTHS, {"first": _birth_sql(89), "second": _birth_sql(88)}),
)
def privacy_birth_year(t: Tables):
    return _rows(t, "orders", "o_orderkey", BIRTHS).select(
        "o_orderkey",
        birth_year_topcode(F.col("born"), AS_OF, 89).alias("first"),
        birth_year_topcode(F.col("born"), AS_OF, 88).alias("second"),
    )


AREAS = {
    "state": STATES.format("c_nationkey"),
    "zip": f"CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '7' ELSE {CUSTOMER_ZIP} END",
}


@query(
    "privacy_zip3",
    f"""
    SELECT c_custkey, state,
      CASE WHEN zip IS NULL THEN '     ' WHEN listed THEN '00000' ELSE substr(zip, 1, 3) || '00' END AS first,
      CASE WHEN zip IS NULL THEN '     ' WHEN listed THEN '00000' ELSE substr(rpad(zip, 5, ' '), 1, 3) || '00' END AS second
    FROM (SELECT *, (state, substr(rpad(coalesce(zip, ''), 5, ' '), 1, 3)) IN (SELECT (STATE_CD, zip_3) FROM ({ZIP_SUPPRESS.sql}))
          AS listed FROM (SELECT c_custkey, {AREAS['state']} AS state, {AREAS['zip']} AS zip FROM customer))
    """,
)
def privacy_zip3(t: Tables):
    rows = _rows(t, "customer", "c_custkey", AREAS)
    rows = rows.withColumn("area", F.substring(F.rpad(F.coalesce("zip", F.lit("")), 5, " "), 1, 3))
    rows = flag_if_in(rows, ZIP_SUPPRESS.df(t), {"state": "STATE_CD", "area": "zip_3"}, "listed", yes=True, no=False)
    c, listed = F.col("zip"), F.col("listed")
    return rows.select(
        "c_custkey",
        "state",
        zip3_generalise(c, c, listed).alias("first"),
        zip3_generalise(c, c, listed, pad_first=True).alias("second"),
    )


PRESCRIBERS = {
    "state": f"CASE c_custkey % 11 WHEN 0 THEN NULL ELSE {STATES.format('c_nationkey')} END",
    "number": "CASE c_custkey % 7 WHEN 0 THEN NULL ELSE ' B*' || cast(c_custkey AS string) || ' ' END",
}


@query(
    "privacy_suppress",
    _sql("customer", "c_custkey", PRESCRIBERS, {
        "shown": "CASE WHEN number IS NULL OR state IS NULL OR upper(state) IN ('WI', 'MN') THEN repeat(' ', 9) ELSE "
        + duck.text("number", 9, trim="trim", null=None) + " END",
    }),
)
def privacy_suppress(t: Tables):
    state = F.col("state")
    hidden = state.isNull() | in_any_case(state, ["WI", "MN"])
    return _rows(t, "customer", "c_custkey", PRESCRIBERS).select(
        "c_custkey", suppress_when(F.col("number"), hidden, 9).alias("shown")
    )


@query(
    "encode_base64",
    "SELECT c_custkey, base64(encode(c_name)) AS c_name, base64(encode(cast(c_nationkey AS VARCHAR))) AS c_nationkey "
    "FROM customer",
)
def encode_base64_query(t: Tables):
    return encode_base64(t.customer.select("c_custkey", "c_name", "c_nationkey"), ["c_name", "c_nationkey"])


@query("tokenise_ids", f"SELECT sha256('{SALT}' || c_custkey) AS token, c_mktsegment FROM customer")
def tokenise_ids(t: Tables):
    return t.customer.select(tokenise(F.col("c_custkey"), SALT).alias("token"), "c_mktsegment")


@query(
    "publish_tokens",
    f"SELECT DISTINCT base64(encode(sha256('{SALT}' || o_custkey))) AS user_id, o_orderpriority AS priority FROM orders",
)
def publish_tokens(t: Tables):
    rows = t.orders.selectExpr("o_custkey AS user_id", "o_orderpriority AS priority")
    return publish_token(rows, "user_id", tokenise(F.col("user_id"), SALT))


NAMED = {"name": "CASE WHEN c_nationkey = 5 THEN NULL ELSE c_name || ' é' END"}


def altered(token, where):
    """The token with one hexadecimal digit of its bytes replaced by the next, at a place that varies by row."""
    digits = F.hex(F.unbase64(token))
    at = F.pmod(where, F.length(digits)) + 1
    other = F.translate(F.substring(digits, at, F.lit(1)), "0123456789ABCDEF", "123456789ABCDEF0")
    return base64_line(F.unhex(F.overlay(digits, other, at)))


@query(
    "protect_roundtrip",
    """
    SELECT CASE WHEN NOT broken THEN name END AS name, broken, count(*) AS people,
      count(DISTINCT CASE WHEN NOT broken THEN name END) AS tokens
    FROM (SELECT CASE WHEN c_nationkey = 5 THEN NULL ELSE c_mktsegment || ' é' END AS name, c_custkey % 4 = 0 AS broken FROM customer)
    GROUP BY 1, 2
    """,
)
def protect_roundtrip(t: Tables):
    """Equal values share one token, every token opens to its value, and an altered token does not open."""
    ring = fresh_keys("1")
    rows = t.customer.selectExpr(
        "CASE WHEN c_nationkey = 5 THEN NULL ELSE c_mktsegment || ' é' END AS name", "c_custkey % 4 = 0 AS broken", "c_custkey"
    )
    token = ring.protect(F.col("name"), "1")
    tokens = rows.select("broken", F.when(F.col("broken"), altered(token, F.col("c_custkey"))).otherwise(token).alias("token"))
    clear = tokens.select(ring.unprotect(F.col("token"), "1").alias("name"), "broken", "token")
    sound = F.when(~F.col("broken"), F.col("token"))
    return clear.groupBy("name", "broken").agg(F.count("*").alias("people"), F.count_distinct(sound).alias("tokens"))


@query(
    "reprotect_column",
    _sql("customer", "c_custkey", NAMED, {
        "name": "CASE WHEN c_custkey % 3 > 0 THEN name END", "changed": "name IS NOT NULL AND c_custkey % 3 > 0"
    }),
)
def reprotect_column(t: Tables):
    """A token moved from one key to another: it differs, and opens with the new key. An altered token is not moved."""
    ring = fresh_keys("8000", "1")
    rows = _rows(t, "customer", "c_custkey", NAMED)
    stored = ring.protect(F.col("name"), "8000")
    stored = F.when(F.col("c_custkey") % 3 == 0, altered(stored, F.col("c_custkey"))).otherwise(stored)
    rows = rows.select("c_custkey", stored.alias("old"))
    rows = rows.withColumn("new", ring.reprotect(F.col("old"), "8000", "1"))
    return rows.select(
        "c_custkey",
        ring.unprotect(F.col("new"), "1").alias("name"),
        F.coalesce(F.col("old") != F.col("new"), F.lit(False)).alias("changed"),
    )
