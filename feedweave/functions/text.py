"""Text fields: cleaning, padding, defaults, recodes."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import FIELD_SEPARATOR, PLAIN_TEXT


def listed(drop: str) -> str:
    """A character class with its ranges written out: Java tests listed characters by one table, ranges one after the other."""
    return re.sub(r"(\w)-(\w)", lambda m: "".join(map(chr, range(ord(m[1]), ord(m[2]) + 1))), drop)


def clean(c: Column, drop: str = PLAIN_TEXT) -> Column:
    """Remove every character matched by the class ``drop``."""
    return F.regexp_replace(c, listed(drop), "")


def cleaned_together(texts: Sequence[Column], drop: str = PLAIN_TEXT) -> Column:
    """All texts cleaned, as one array; null is empty there.

    The texts are joined, cleaned by one pass, and split again. Where one of them holds the
    joining character itself, the row's texts are cleaned one by one.
    """
    full = [F.coalesce(t, F.lit("")) for t in texts]
    kept = drop[:2] + FIELD_SEPARATOR + drop[2:]  # the class of what is dropped, without the joining character
    joined = F.split(clean(F.concat_ws(FIELD_SEPARATOR, *full), kept), FIELD_SEPARATOR, -1)
    # all texts or none; both uses of what was split are always evaluated, so that Spark makes it once
    whole = F.slice(joined, F.lit(1), F.when(F.size(joined) == len(full), F.lit(len(full))).otherwise(F.lit(0)))
    return F.when(F.size(whole) > 0, whole).otherwise(F.transform(F.array(*full), lambda t: clean(t, drop)))


def pad(c: Column, width: int, side: str, fill: str = " ") -> Column:
    """Pad to ``width`` on one side; longer text keeps its leftmost characters."""
    return F.lpad(c, width, fill) if side == "left" else F.rpad(c, width, fill)


def pad_or_overflow(c: Column, width: int, side: str, fill: str = " ") -> Column:
    """Pad like :func:`pad`, but leave longer text whole so that the layout check sees it."""
    room = F.greatest(F.length(c), F.lit(width))
    return F.lpad(c, room, F.lit(fill)) if side == "left" else F.rpad(c, room, F.lit(fill))


def clean_pad(
    c: Column,
    width: int,
    side: str = "right",
    fill: str = " ",
    drop: str | None = PLAIN_TEXT,
    trim: str = "left",
    null_text: str | None = "",
) -> Column:
    """Clean (unless ``drop`` is None), trim, replace null by ``null_text`` (None keeps null), then pad and truncate."""
    text = c if drop is None else clean(c, drop)
    if trim == "left":
        text = F.ltrim(text)
    elif trim == "both":
        text = F.trim(text)
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    return pad(text, width, side, fill)


def default_if_blank(
    c: Column, default: str, blank_too: bool = True, trim_first: bool = False, cleaned: Column | None = None
) -> Column:
    """``default`` for null (and, if asked, for ''), otherwise the cleaned text, unpadded.

    ``trim_first`` trims before cleaning, so a blank uncovered by cleaning stays. ``cleaned`` is the text
    already cleaned.
    """
    text = clean(F.ltrim(c)) if trim_first else F.ltrim(clean(c) if cleaned is None else cleaned)
    missing = c.isNull() | (c == "") if blank_too else c.isNull()
    return F.when(missing, F.lit(default)).otherwise(text)


def filler(width: int) -> Column:
    return F.lit(" " * width)


def constant(text: str, width: int) -> Column:
    return F.lit(text.rjust(width)[:width])


def presence_flag(c: Column, when_null: str, when_set: str) -> Column:
    return F.when(c.isNull(), F.lit(when_null)).otherwise(F.lit(when_set))


def code_map(c: Column, codes: Mapping[str, str], default: str | None, null_code: str | None = None) -> Column:
    """Recode by value. ``null_code`` is used for null; without it null takes the default."""
    out = F.when(c.isNull(), F.lit(null_code)) if null_code is not None else None
    for value, code in codes.items():
        out = (F if out is None else out).when(c == value, F.lit(code))
    return out.otherwise(F.lit(default))


def has_text_at(c: Column, parts: Iterable[tuple[int, str]]) -> Column:
    """True when any ``text`` stands at its 1-based ``start``; null input is false."""
    hit = F.lit(False)
    for start, text in parts:
        hit = hit | (F.substring(c, start, len(text)) == text)
    return F.coalesce(hit, F.lit(False))


def in_any_case(c: Column, words: Iterable[str]) -> Column:
    """Is the text one of the short words, in any mix of ASCII cases? Null input gives null.

    The spellings are listed, which is far cheaper per row than changing the case of the text.
    """
    spellings = [
        "".join(letters) for w in words for letters in product(*[sorted({x.lower(), x.upper()}) for x in w])
    ]
    return c.isin(spellings)


def suppress_when(c: Column, condition: Column, width: int) -> Column:
    """Spaces when the value is null or the condition holds, else cleaned text of ``width``."""
    hidden = c.isNull() | F.coalesce(condition, F.lit(False))
    return F.when(hidden, filler(width)).otherwise(clean_pad(c, width, trim="both", null_text=None))


def override_by_key(key: Column, fixed: Mapping[str, str], otherwise: Column) -> Column:
    """A fixed text for the listed keys, the given column for all others."""
    out = None
    for value, text in fixed.items():
        out = (F if out is None else out).when(key == value, F.lit(text))
    return otherwise if out is None else out.otherwise(otherwise)


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def is_filled(c: Column) -> Column:
    """Not null and not blank after trimming."""
    return F.trim(c) != ""


def product_code(compound: Column, ndc: Column, width: int, drop: str | None = PLAIN_TEXT) -> Column:
    """The product code of a non-compound drug (compound code null or ''), else spaces."""
    plain = compound.isNull() | (compound == "")
    return F.when(plain & ndc.isNotNull(), clean_pad(ndc, width, drop=drop, null_text=None)).otherwise(filler(width))


def product_code_kind(code: Column) -> Column:
    """Qualifier of a padded product code: 'N ' when it has text, 'Z ' when blank."""
    return F.when(code.isNull(), filler(2)).when(F.trim(code) != "", F.lit("N ")).otherwise(F.lit("Z "))
