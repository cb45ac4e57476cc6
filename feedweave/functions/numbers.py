"""Numeric fields. All arithmetic is decimal; text that is no number becomes null, never an error.

Values too long for their field are returned whole, so that the layout check
rejects the record instead of writing cut digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, filler, pad_or_overflow


def to_number(c: Column) -> Column:
    return c.try_cast("decimal(30,8)")


def to_integer(c: Column, kind: str = "int") -> Column:
    """Whole number, fraction cut; null when the input is no number or does not fit."""
    return to_number(c).try_cast(kind)


def clamp_ordinal(c: Column, negative: str | None = None) -> Column:
    """0 and null give '00', 1..100 give the value less one, more gives '99'.

    A value below zero gives ``negative``; None leaves the field null, which
    shortens the record and so rejects it.
    """
    n = to_integer(c)
    shown = F.lpad((F.least(F.greatest(n, F.lit(1)), F.lit(100)) - 1).cast("string"), 2, "0")
    return F.when(n >= 0, shown).when(n < 0, F.lit(negative)).when(c.isNull(), F.lit("00"))


def clamp_abs(c: Column, cap: int = 99) -> Column:
    """Magnitude, at most ``cap``, zero-padded to the width of the cap; null gives zeros."""
    width = len(str(cap))
    n = to_number(c)
    shown = F.lpad(F.least(F.abs(n), F.lit(cap)).cast("int").cast("string"), width, "0")
    return F.when(n.isNotNull(), shown).when(c.isNull(), F.lit("0" * width))


def offset_key(c: Column, offset: int, width: int, side: str, fill: str, cleaned: bool = True) -> Column:
    """Add ``offset`` to an integer key. Null when the text is no number.

    A number of more than 37 digits is beyond exact arithmetic and returned unchanged: it is
    too wide for any field, so the layout check rejects the record and the reject shows it whole.
    """
    text = F.ltrim(clean(c)) if cleaned else F.trim(c)
    whole = F.substring_index(text, ".", 1)
    shifted = (whole.try_cast("decimal(37,0)") + F.lit(offset)).cast("string")
    huge = F.when((F.length(whole) > 37) & whole.rlike("^[+-]?[0-9]+$"), whole)
    return pad_or_overflow(F.coalesce(shifted, huge), width, side, fill)


def offset_key_or_zeros(c: Column, offset: int, width: int) -> Column:
    return F.coalesce(offset_key(c, offset, width, "left", "0"), F.lit("0" * width))


def hex_id(c: Column, width: int) -> Column:
    """Decimal id to upper-case hexadecimal, padded right; null or no digits gives spaces.

    ``conv`` raises beyond 64 bits: an id of more than 19 digits is returned unchanged, which is
    too wide for the field, so the record is rejected.
    """
    digits = F.regexp_replace(clean(c), "^0+(?=[0-9])", "")
    shown = F.when(F.length(digits) > 19, digits).otherwise(F.conv(digits, 10, 16))
    return pad_or_overflow(F.coalesce(shown, F.lit("")), width, "right")


def quantity(c: Column, whole: int = 7, places: int = 3) -> Column:
    """``whole`` zero-padded digits followed by ``places`` fraction digits, further places cut."""
    width = whole + places
    scaled = (to_number(c) * 10**places).try_cast("bigint")
    digits = pad_or_overflow(scaled.cast("string"), width, "left", "0")
    return F.when(scaled >= 0, digits).when(scaled < 0, F.format_string(f"%0{width}d", scaled))


def quantity_or(c: Column, fill: str, whole: int = 7, places: int = 3) -> Column:
    return F.coalesce(quantity(c, whole, places), F.when(c.isNull(), F.lit(fill * (whole + places))))


def money(c: Column, whole: int = 6) -> Column:
    """Space-padded whole part and two digits of cents, rounded half up first.

    The whole part is blank for amounts between zero and one; the sign is kept.
    """
    n = to_number(c)
    # the point goes, and with it a zero that stands alone before it
    digits = F.regexp_replace(F.round(n, 2).cast("string"), r"^(-?)0\.|\.", "$1")
    return pad_or_overflow(F.when(n == 0, F.lit("000")).otherwise(digits), whole + 2, "left")


def money_or_spaces(c: Column, whole: int = 6) -> Column:
    return F.coalesce(money(c, whole), F.when(c.isNull(), filler(whole + 2)))


def money_flagged(flag: Column, c: Column, whole: int = 6) -> Column:
    """Zeros when flagged 'Y'; spaces when 'N' and null; otherwise the amount."""
    width = whole + 2
    unflagged = F.coalesce(money(c, whole), F.when((flag == "N") & c.isNull(), filler(width)))
    return F.when(flag == "Y", F.lit("0" * width)).otherwise(unflagged)
