"""Lookup joins: flags, exclusions and listed terms.

Nothing is broadcast by hint. Spark broadcasts a lookup by itself while its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
joins by shuffle, where adaptive execution splits hot keys of the fact side.
Lookups are reduced to distinct keys first, so a join never multiplies rows. Where the
fact side is wide, ``stored_keys`` writes these keys before the join is planned: of keys still to be
computed Spark knows no size, and shuffles the fact side before it learns that they are few.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .joins import join_on_struct


def _key_side(lookup: DataFrame, keys: Mapping[str, str], prefix: str) -> DataFrame:
    picked = [F.col(theirs).alias(f"{prefix}{i}") for i, theirs in enumerate(keys.values())]
    named = lookup.select(*picked)
    return named.na.drop().distinct()


def stored_keys(lookup: DataFrame, *keys: str) -> DataFrame:
    """The distinct keys without nulls, as a table of measured size."""
    return stored(lookup.select(*keys).na.drop().distinct(), "lookup")


def _matched(df: DataFrame, side: DataFrame, keys: Mapping[str, str], prefix: str) -> Column:
    cond = F.lit(True)
    for i, ours in enumerate(keys):
        cond = cond & (df[ours] == side[f"{prefix}{i}"])
    return cond


def flag_if_in(
    df: DataFrame, lookup: DataFrame, keys: Mapping[str, str], name: str, yes: object = "Y", no: object = "N"
) -> DataFrame:
    """Indicator column: is the row's key among the lookup's keys? ``keys`` maps ours to theirs."""
    prefix = f"__{name}_"
    side = _key_side(lookup, keys, prefix)
    joined = join_on_struct(df, side, {ours: f"{prefix}{i}" for i, ours in enumerate(keys)}, "left")
    hit = F.col(f"{prefix}0").isNotNull()
    return joined.select(*[df[c] for c in df.columns], F.when(hit, F.lit(yes)).otherwise(F.lit(no)).alias(name))


def exclude_if_in(df: DataFrame, lookup: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Drop rows whose key is in the lookup; rows with a null key stay."""
    side = _key_side(lookup, keys, "__x")
    return df.join(side, _matched(df, side, keys, "__x"), "left_anti")


def keep_if_in(df: DataFrame, lookup: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Keep rows whose key is in the lookup: an existence test, no fan-out.

    A semi join needs no deduplicated lookup.
    """
    cond = F.lit(True)
    side = lookup.select(*[F.col(t).alias(f"__k{i}") for i, t in enumerate(keys.values())])
    return df.join(side, _matched(df, side, keys, "__k"), "left_semi")


def attach_override(df: DataFrame, lookup: DataFrame, key: Mapping[str, str], value: str, target: str) -> DataFrame:
    """Replace ``target`` by the lookup's ``value`` for listed keys.

    Of several values for one key the least that is not null counts; null keys match nothing.
    """
    prefix = "__o"
    named = lookup.select(
        *[F.col(t).alias(f"{prefix}{i}") for i, t in enumerate(key.values())], F.col(value).alias("__value")
    )
    keys = [f"{prefix}{i}" for i in range(len(key))]
    side = named.na.drop(subset=keys).groupBy(*keys).agg(F.min("__value").alias("__value"))
    joined = join_on_struct(df, side, dict(zip(key, keys)), "left")
    shown = {target: F.coalesce(F.col("__value"), df[target]).alias(target)}
    return joined.select(*[shown.get(c, df[c]) for c in df.columns])


def _listed(terms: DataFrame, term_column: str) -> DataFrame:
    text = F.col(term_column).cast("string").alias("term")
    return terms.select(text).filter(F.col("term") != "").distinct()


def _name_key(c: Column) -> Column:
    """Stands for a text of any length in shuffles."""
    return F.sha2(c, 256)


# Characters of the pieces by which texts and terms meet.
GRAM = 3


def _pieces(c: Column, size: int) -> Column:
    """All distinct pieces of ``size`` characters, in one pass over the text however long it is."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _by_piece(texts: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(key, piece) of the texts, for the wanted pieces only."""
    pieces = texts.select("key", F.explode(_pieces(F.col("text"), size)).alias("piece"))
    return pieces.join(wanted, "piece", "left_semi")


def keys_with_terms(df: DataFrame, column: str, terms: DataFrame, term_column: str) -> DataFrame:
    """The keys (as ``key``, once each) of the texts that contain any listed term, without a cross join.

    An inverted index on pieces of ``GRAM`` characters: each term is looked up under the one of its pieces that
    the fewest texts hold, and the texts found there are checked for the whole term. The work does not depend on how many
    lengths the terms have. Terms shorter than a piece are pieces themselves. Pieces travel with a key of fixed
    size; a text travels once, to be checked.
    """
    listed = _listed(terms, term_column)
    texts = df.select(F.col(column).alias("text")).filter(F.col("text") != "").distinct()
    texts = texts.withColumn("key", _name_key(F.col("text")))

    long = listed.filter(F.length("term") >= GRAM)
    index = long.select("term", F.explode(_pieces(F.col("term"), GRAM)).alias("piece"))
    held = _by_piece(texts, index.select("piece").distinct(), GRAM)
    # a term with a piece that no text holds is in no text
    counts = index.join(held.groupBy("piece").count(), "piece", "left")
    rarest = counts.groupBy("term").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "piece")).alias("least"))
    rarest = rarest.filter("least.n > 0").select("term", "least.piece")
    candidates = held.join(rarest, "piece").select("key", "term")
    found = texts.join(candidates, "key").filter(F.contains("text", "term")).select("key")
    for size in range(1, GRAM):
        short = listed.filter(F.length("term") == size).select(F.col("term").alias("piece"))
        found = found.unionByName(_by_piece(texts, short, size).select("key"))
    return found.distinct()


def flag_terms(df: DataFrame, column: str, terms: DataFrame, term_column: str, name: str, wide: bool = False) -> DataFrame:
    """Boolean column: does the text contain any listed term? Null and empty text: false.

    Terms are literal, case-sensitive and taken as they are listed, blanks at their ends
    included; empty and null terms are dropped, and an empty list matches nothing. For ``wide`` rows the distinct texts
    are stored first, so that the rows are made once for them and not for each use, then the keys of those found.
    """
    texts = stored(df.select(column).filter(F.col(column) != "").distinct(), "texts") if wide else df
    side = keys_with_terms(texts, column, terms, term_column)
    side = stored_keys(side, "key") if wide else side
    keyed = df.withColumn("__text_key", _name_key(F.col(column)))
    return flag_if_in(keyed, side, {"__text_key": "key"}, name, yes=True, no=False).drop("__text_key")


def exclude_terms(df: DataFrame, column: str, terms: DataFrame, term_column: str) -> DataFrame:
    """Drop rows whose text contains a listed term; null and empty text stay."""
    return flag_terms(df, column, terms, term_column, "__hit").filter(~F.col("__hit")).drop("__hit")


def count_terms(df: DataFrame, column: str, terms: DataFrame, term_column: str, name: str) -> DataFrame:
    """One row: how many rows contain a listed term."""
    return flag_terms(df, column, terms, term_column, "__hit").agg(F.count_if(F.col("__hit")).alias(name))
