"""Purchase feed: loyalty purchases of a time window, for the online accounts behind them.

Sales lines meet their loyalty header, quantities are totalled per item and
price, loyalty ids become online account ids, sensitive products, excluded
regions and opted-out people leave, and the account id is published as a token.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions.dates import compact_date_window
from ..functions.numbers import to_integer
from ..functions.privacy import KeyRing, publish_token
from ..functions.text import is_filled
from ..operators import filters, lookups
from ..operators.dedupe import dedupe_keys, latest_per_key
from ..operators.joins import join_on_struct
from ..operators.totals import MONEY, total_per_group
from ..session import stored
from ..sources.publishing import Publication
from ..sources.writers import write_with_manifest


@dataclass(frozen=True)
class Tables:
    """The inputs, by role, with the column names of the source tables."""

    sales: DataFrame
    product_master: DataFrame
    assortment: DataFrame
    category: DataFrame
    store_map: DataFrame
    article_map: DataFrame
    identity: DataFrame
    opt_outs: DataFrame
    stores: DataFrame
    addresses: DataFrame


@dataclass(frozen=True)
class Settings:
    first_day: dt.date
    last_day: dt.date
    study_codes: Sequence[int] = fixed.SENSITIVE_STUDY_CODES
    category_codes: Sequence[int] = fixed.SENSITIVE_CATEGORY_CODES
    category_name_part: str = fixed.SENSITIVE_CATEGORY_NAME
    excluded_states: Sequence[str] = (fixed.EXCLUDED_STATE,)
    excluded_city_part: str | None = fixed.EXCLUDED_CITY
    token_key_id: str = fixed.PERSON_KEY_ID
    keys: KeyRing | None = field(default=None, repr=False)

    @classmethod
    def for_run(cls, run_date: dt.date, **other: object) -> Settings:
        """The rolling window: the day before the run date and the run date."""
        return cls(first_day=run_date - dt.timedelta(days=1), last_day=run_date, **other)


# the part of a run's folder that holds the feed, and the name it is published under
FEED = "feed"
SALE_KEYS = ("RFN", "STORE_NBR", "SALES_TXN_DT")
SLICE = "__slice"
# Staged rows that a bucket is meant for: it is written and read by one task.
BUCKET_ROWS = 2_000_000
# Staged rows above which a table is written in several passes, and the most passes: each reads all sales.
PASS_ROWS, PASSES = 50_000_000, 4
# Joins on a staged table need no shuffle if the columns it is dealt by are among the keys; set by sessions that read one.
CO_LOCATED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
LINE_KEYS = ("RFN", "UPC_NBR", "SALES_TXN_DT", "LINE_ITEM_SEQ_NBR", "STORE_NBR")
PRICE_KEYS = ("RFN", "UPC_NBR", "SALES_TXN_DT", "PRICE", "STORE_NBR")


def sales_in_window(sales: DataFrame, cfg: Settings) -> DataFrame:
    """Typed sales records of the window; the date filter is on the raw text."""
    return (
        sales.filter(F.col("RECORDTYP").isin(fixed.LINE_RECORD, fixed.HEADER_RECORD))
        .filter(compact_date_window(F.col("SALES_TXN_DT"), cfg.first_day, cfg.last_day))
        .filter(F.try_to_timestamp("SALES_TXN_DT", F.lit(fixed.DATE_PATTERN)).isNotNull())
        .filter(is_filled(F.col("RFN")))
        .select(
            F.col("RECORDTYP").cast("int").alias("RECORDTYP"),
            "RFN",
            F.col("SALES_TXN_DT").alias("SALES_TXN_DT"),
            "STORE_NBR",
            to_integer(F.col("UPC_NBR"), "long").alias("UPC_NBR"),
            "ARTICLE_NBR",
            to_integer(F.col("LINE_ITEM_SEQ_NBR")).alias("LINE_ITEM_SEQ_NBR"),
            to_integer(F.col("UNIT_QTY")).alias("UNIT_QTY"),
            F.col("ITEM_UNIT_PRICE_DLRS").try_cast(MONEY).alias("PRICE"),
            F.col("loyalty_id").alias("LOYALTY_ID"),
            *staged_by(sales),
        )
    )


def staged_by(sales: DataFrame) -> list[str]:
    """The column that says by what a staged table is dealt besides the transaction; nothing for any other table."""
    return [SLICE] if SLICE in sales.columns else []


def stage_sales(sales: DataFrame, table: str, path: str, buckets: int, hot_rows: int = 1_000_000, slices: int = 256) -> DataFrame:
    """Write the sales as a table bucketed by transaction, whose lines and headers then meet without a shuffle.

    A transaction of more than ``hot_rows`` rows is dealt over up to ``slices`` buckets by item, and its headers are repeated
    in each of them. Lines of one line key, and of one item and price, have one item and so lie together. The
    session that reads the table must allow co-location by part of the keys (``CO_LOCATED``), else Spark shuffles it as
    any other. Rows stay as they are, but for the repeated headers, which count once in the feed. A bucket is the work of one task:
    there are ``buckets`` of them, or more, so that they do not grow with the table beyond ``BUCKET_ROWS`` rows on average. Rows are
    shuffled twice; a large table is written by transactions in up to ``PASSES`` passes, so that the disk holds the shuffles of one of them beside it.
    """
    header = F.coalesce(F.col("RECORDTYP") == fixed.HEADER_RECORD, F.lit(False))
    counts = stored(sales.groupBy("RFN").agg(F.count("*").alias("rows"), F.count_if(header).alias("headers")), "transactions")
    copies = F.when(F.col("RFN").isNotNull() & (F.col("rows") > hot_rows), F.col("headers") * (slices - 1)).otherwise(0)
    rows = counts.agg(F.sum(F.col("rows") + copies)).first()[0] or 0
    buckets = max(buckets, -(-rows // BUCKET_ROWS))
    hot = counts.filter(F.col("rows") > hot_rows)
    by_item = F.pmod(F.xxhash64(to_integer(F.col("UPC_NBR"), "long")), F.lit(slices)).cast("int")
    every = F.sequence(F.lit(0), F.lit(slices - 1))
    places = F.when(F.col("__hot") & header, every).when(F.col("__hot"), F.array(by_item)).otherwise(F.array(F.lit(0)))
    passes = max(1, min(PASSES, -(-rows // PASS_ROWS)))
    for k in range(passes):
        some = sales.filter(F.pmod(F.xxhash64("RFN"), F.lit(passes)) == k) if passes > 1 else sales
        marked = lookups.flag_if_in(some, hot, {"RFN": "RFN"}, "__hot", yes=True, no=False)
        dealt = marked.withColumn(SLICE, F.explode(places)).drop("__hot").repartition(buckets, "RFN", SLICE)
        kept = dealt.write.mode("append" if k else "overwrite").option("path", path).option("compression", "zstd")
        kept.bucketBy(buckets, "RFN", SLICE).sortBy("RFN", SLICE).saveAsTable(table)
    return sales.sparkSession.table(table)


def loyalty_lines(sales: DataFrame) -> DataFrame:
    """Item lines with the loyalty id of their transaction's header.

    Repeated headers count once; a transaction with several loyalty ids repeats its lines,
    which :func:`item_totals` reduces to one per line key.
    """
    kinds, keys = F.col("RECORDTYP"), [*SALE_KEYS, *staged_by(sales)]
    headers = sales.filter((kinds == fixed.HEADER_RECORD) & is_filled(F.col("LOYALTY_ID"))).select(
        *keys, "LOYALTY_ID"
    ).distinct()
    lines = sales.filter((kinds == fixed.LINE_RECORD) & (F.col("UNIT_QTY") >= 0))
    lines = filters.complete_rows(
        lines.drop("LOYALTY_ID", "RECORDTYP"),
        ["SALES_TXN_DT", "PRICE", "RFN", "UNIT_QTY", "UPC_NBR", "ARTICLE_NBR", "LINE_ITEM_SEQ_NBR"],
    )
    named = headers.select(*[F.col(k).alias(f"__{k}") for k in keys], "LOYALTY_ID")
    # keys of a header are never null here: a null one would meet its like in the struct
    named = named.na.drop(subset=[f"__{k}" for k in keys])
    if staged_by(sales):
        joined = lines.join(named, reduce(and_, [F.col(k) == F.col(f"__{k}") for k in keys]))
    else:
        joined = join_on_struct(lines, named, {k: f"__{k}" for k in keys})
    return joined.drop(*[f"__{k}" for k in keys])


def mapped_stores(lines: DataFrame, store_map: DataFrame, stores: DataFrame, cfg: Settings) -> DataFrame:
    """Replace the site code by the store number; keep allowed stores only.

    The store number is part of every later key, so stores can leave this early.
    """
    sites = store_map.select("ZWERKS", to_integer(F.col("ZLOC_NUM")).alias("store")).na.drop().distinct()
    allowed = filters.exclude_region(
        filters.current_rows(stores, "edw_rec_end_dt"),
        "store_str_state_cd",
        cfg.excluded_states,
        "store_str_city",
        cfg.excluded_city_part,
    )
    allowed = allowed.select(to_integer(F.col("store_nbr")).alias("store"))
    located = lookups.keep_if_in(sites, allowed, {"store": "store"})
    joined = lines.join(located, lines["STORE_NBR"] == located["ZWERKS"], "inner")
    return joined.select(
        *[lines[c] for c in lines.columns if c != "STORE_NBR"], F.col("store").alias("STORE_NBR")
    )


def item_totals(lines: DataFrame) -> DataFrame:
    """One row per line key, then the quantity per item, price and store."""
    within = ["RFN", *staged_by(lines)] if staged_by(lines) else []
    single = dedupe_keys(lines, [*LINE_KEYS, *staged_by(lines)], ["PRICE", "UNIT_QTY", "ARTICLE_NBR", "LOYALTY_ID"])
    totals = total_per_group(single, PRICE_KEYS, "UNIT_QTY", "QTY", drop=["LINE_ITEM_SEQ_NBR"], within=within)
    return totals.drop(SLICE)


def online_ids(identity: DataFrame) -> DataFrame:
    """Loyalty id -> the newest online account id of the same person."""
    open_rows = filters.current_rows(identity, "dna_end_dttm", text_prefix=True)
    loyalty = open_rows.filter(F.col("cust_src_cd") == fixed.LOYALTY_SOURCE).select(
        "mid", F.col("cust_src_id").alias("LR_ID")
    )
    online = open_rows.filter(F.col("cust_src_cd") == fixed.ONLINE_SOURCE)
    newest = latest_per_key(online, ["mid"], "dna_update_dttm", ["cust_src_id"]).select(
        F.col("mid").alias("online_mid"), F.col("cust_src_id").alias("ECOMM_ID")
    )
    known = newest.filter(F.col("ECOMM_ID").isNotNull() & F.col("online_mid").isNotNull())
    return join_on_struct(loyalty, known, {"mid": "online_mid"}).select("LR_ID", "ECOMM_ID")


def attach_identity(lines: DataFrame, identity: DataFrame) -> DataFrame:
    ids = online_ids(identity)
    joined = lines.join(ids, lines["LOYALTY_ID"] == ids["LR_ID"], "inner")
    return joined.drop("LR_ID")


def sellable_products(tables: Tables, cfg: Settings) -> DataFrame:
    """Product rows outside the sensitive studies and categories, with their SKU, each once."""
    master = tables.product_master.select(
        "ARTICLE_NBR",
        to_integer(F.col("UPC"), "long").alias("UPC_NBR"),
        to_integer(F.substring("NODE", 9, 3)).alias("opStudy"),
    )
    master = filters.exclude_codes(master, "opStudy", cfg.study_codes).select("ARTICLE_NBR", "UPC_NBR")
    articles = tables.article_map.select(
        F.col("ZARTICLE").alias("ARTICLE_NBR"),
        to_integer(F.col("ZUPC"), "long").alias("UPC_NBR"),
        to_integer(F.col("ZUPCWOCHECK"), "long").alias("ZUPCWOCHECK"),
        to_integer(F.col("ZWIC")).alias("WIC_NBR"),
    )
    category = filters.complete_rows(tables.category, ["UPC_NBR", "PROD_CAT_NBR"])
    category = filters.exclude_sensitive_category(
        category, "PROD_CAT_NAME", "PROD_CAT_NBR", cfg.category_name_part, cfg.category_codes
    ).select(to_integer(F.col("UPC_NBR"), "long").alias("__category_upc"))
    products = master.join(articles, ["ARTICLE_NBR", "UPC_NBR"], "inner")
    # only existence in an allowed category matters for the feed
    products = lookups.keep_if_in(products, category, {"ZUPCWOCHECK": "__category_upc"})
    active = F.col("SKU_ID").isNotNull() & (F.col("STATUS_CODE") == fixed.ACTIVE_STATUS)
    skus = tables.assortment.filter(active).select(
        "ARTICLE_NBR", to_integer(F.col("WIC_NBR")).alias("WIC_NBR"), "SKU_ID"
    )
    return products.join(skus, ["WIC_NBR", "ARTICLE_NBR"], "inner").select(
        "ARTICLE_NBR", "UPC_NBR", "SKU_ID"
    ).distinct()


def allowed_people(lines: DataFrame, addresses: DataFrame, opt_outs: DataFrame, cfg: Settings) -> DataFrame:
    """Keep loyalty ids with an address outside the excluded states that have not opted out."""
    homes = filters.current_rows(addresses, "edw_rec_end_dt").filter(
        F.col("src_sys_cd") == fixed.LOYALTY_SOURCE
    )
    homes = filters.exclude_region(homes, "state_cd", cfg.excluded_states)
    refused = opt_outs.filter(F.col("srccode") == fixed.LOYALTY_SOURCE)
    kept = lookups.keep_if_in(lines, homes, {"LOYALTY_ID": "cust_src_id"})
    return lookups.exclude_if_in(kept, refused, {"LOYALTY_ID": "srcid"})


def build(tables: Tables, cfg: Settings) -> DataFrame:
    """The feed with the clear account id, distinct, still lazy."""
    lines = loyalty_lines(sales_in_window(tables.sales, cfg))
    lines = mapped_stores(lines, tables.store_map, tables.stores, cfg)
    items = item_totals(lines)
    items = allowed_people(items, tables.addresses, tables.opt_outs, cfg)
    items = attach_identity(items, tables.identity)
    return feed_shape(with_products(items, tables, cfg))


def with_products(items: DataFrame, tables: Tables, cfg: Settings) -> DataFrame:
    """Items of sellable products, once for each of their SKUs."""
    return items.join(sellable_products(tables, cfg), ["ARTICLE_NBR", "UPC_NBR"], "inner")


def feed_shape(items: DataFrame) -> DataFrame:
    """The columns of the feed, distinct."""
    return items.select(
        F.col("ECOMM_ID").alias("user_id"),
        F.col("RFN").alias("event_id"),
        F.col("QTY").alias("event_item_quantity"),
        F.col("SKU_ID").alias("event_item_id"),
        F.col("PRICE").alias("event_item_price"),
        F.try_to_timestamp("SALES_TXN_DT", F.lit(fixed.DATE_PATTERN)).alias("event_timestamp"),
        F.col("STORE_NBR").alias("store_id"),
    ).distinct()


def publish(feed: DataFrame, cfg: Settings) -> DataFrame:
    """The feed with the account id as a Base64-encoded reversible token."""
    if cfg.keys is None:
        raise ValueError("publishing needs the key ring")
    return publish_token(feed, "user_id", cfg.keys.protect(F.col("user_id"), cfg.token_key_id))


def run(spark: SparkSession, tables: Tables, cfg: Settings, out: str) -> dict[str, object]:
    """Build, publish and write the feed; returns the manifest.

    The feed is the part ``feed`` of a run's folder under ``out`` and is published as a whole
    (``sources.publishing``): if the run fails, the last feed stays in force.
    """
    with Publication(spark, out) as publication:
        written = write_with_manifest(spark, publish(build(tables, cfg), cfg), publication.path(FEED))
        if not publication.commit([FEED]):
            raise RuntimeError(f"another run has published {out} since this one began")
    return written
