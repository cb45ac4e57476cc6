"""Row filters.

A negated comparison with null is null, so the exclusion filters here also drop
rows whose tested column is null: an exclusion that cannot be checked fails closed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import OPEN_END


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with no null in any of the columns."""
    return df.na.drop(subset=list(columns))


def current_rows(
    df: DataFrame, end_column: str, open_end: str = OPEN_END, text_prefix: bool = False
) -> DataFrame:
    """Current rows of a history table: those whose end is the open end.

    The filter stays on the raw column so that the file reader can use it. A
    timestamp is compared as a half-open day; text must be equal, or with
    ``text_prefix`` begin with the day (text that carries a time).
    """
    end = F.col(end_column)
    kind = df.schema[end_column].dataType.typeName()
    if kind == "string":
        return df.filter(end.startswith(open_end) if text_prefix else end == open_end)
    day = F.lit(dt.date.fromisoformat(open_end))
    if kind == "date":
        return df.filter(end == day)
    return df.filter((end >= day) & (end < F.date_add(day, 1)))


def drop_null_tokens(df: DataFrame, column: str, tokens: Iterable[str] = ("null",)) -> DataFrame:
    """Drop nulls, empty text, two bare quotes, and the words that stand for null."""
    unwanted = ["", '""', *tokens]
    return df.filter(~F.col(column).isin(unwanted))


def comparable(df: DataFrame, column: str, codes: Iterable[object]) -> list[object]:
    """The codes as text when the column is text, so that no cast can fail."""
    is_text = df.schema[column].dataType.typeName() == "string"
    return [str(c) if is_text else c for c in codes]


def exclude_codes(df: DataFrame, column: str, codes: Iterable[object]) -> DataFrame:
    return df.filter(~F.col(column).isin(comparable(df, column, codes)))


def exclude_sensitive_category(
    df: DataFrame, name: str, code: str, name_part: str, codes: Iterable[object]
) -> DataFrame:
    """Drop rows whose category name contains the part or whose code is listed."""
    listed = F.col(code).isin(comparable(df, code, codes))
    return df.filter(~(F.col(name).contains(name_part) | listed))


def exclude_region(
    df: DataFrame, state: str, states: Iterable[str], city: str | None = None, city_part: str | None = None
) -> DataFrame:
    """Drop rows of the listed states, in any case, and of cities containing the given part."""
    keep = ~F.lower(F.col(state)).isin([s.lower() for s in states])
    if city and city_part:
        keep = keep & ~F.lower(F.col(city)).contains(city_part.lower())
    return df.filter(keep)
