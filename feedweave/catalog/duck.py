"""DuckDB expressions for the field formats, written independently of the Spark ones."""

from __future__ import annotations


def clean(c, drop="[^0-9A-Za-z. /-]"):
    return f"regexp_replace({c}, '{drop}', '', 'g')"


def pad(c, width, side="r", fill=" "):
    return f"{side}pad({c}, {width}, '{fill}')"


def grow(c, width, side="r", fill=" "):
    return f"(CASE WHEN length({c}) > {width} THEN {c} ELSE {pad(c, width, side, fill)} END)"


def text(c, width, side="r", fill=" ", trim="ltrim", drop="[^0-9A-Za-z. /-]", null=""):
    inner = clean(c, drop)
    inner = f"{trim}({inner})" if trim else inner
    if null is not None:
        inner = f"coalesce({inner}, '{null}')"
    return pad(inner, width, side, fill)


def spaces_if_null(c, width, otherwise):
    return f"CASE WHEN {c} IS NULL THEN repeat(' ', {width}) ELSE {otherwise} END"


def when_text(c, pattern, width, side="l"):
    return pad(f"coalesce(strftime(try_cast({c} AS TIMESTAMP), '{pattern}'), '')", width, side)


def date8(c):
    return when_text(c, "%Y%m%d", 8)


def time8(c):
    """Times arrive as HH:mm:ss text, which DuckDB only casts to TIME."""
    return pad(f"coalesce(strftime(DATE '2000-01-01' + try_cast({c} AS TIME), '%H:%M:%S'), '')", 8, "l")


def number(c):
    return f"try_cast({c} AS DECIMAL(30,8))"


def ordinal(c, negative):
    n = f"cast(trunc({number(c)}) AS BIGINT)"
    return (
        f"CASE WHEN {c} IS NULL OR {n} = 0 THEN '00' WHEN {n} > 100 THEN '99' "
        f"WHEN {n} >= 1 THEN lpad(cast({n} - 1 AS VARCHAR), 2, '0') WHEN {n} < 0 THEN {negative} END"
    )


def clamp(c):
    n = f"abs({number(c)})"
    return (
        f"CASE WHEN {c} IS NULL THEN '00' WHEN {n} > 99 THEN '99' "
        f"ELSE lpad(cast(cast(trunc({n}) AS BIGINT) AS VARCHAR), 2, '0') END"
    )


def quantity(c, null_fill):
    n = number(c)
    scaled = f"cast(cast(trunc(abs({n}) * 1000) AS HUGEINT) AS VARCHAR)"
    return (
        f"CASE WHEN {c} IS NULL THEN repeat('{null_fill}', 10) "
        f"WHEN {n} < 0 AND trunc(abs({n}) * 1000) > 0 THEN '-' || {grow(scaled, 9, 'l', '0')} ELSE {grow(scaled, 10, 'l', '0')} END"
    )


def money(c):
    n = f"round({number(c)}, 2)"
    whole = f"cast(trunc(abs({n})) AS HUGEINT)"
    part = (
        f"(CASE WHEN {n} < 0 THEN '-' ELSE '' END || "
        f"CASE WHEN {whole} = 0 AND {number(c)} <> 0 THEN '' ELSE cast({whole} AS VARCHAR) END)"
    )
    cents = f"lpad(cast(cast(abs({n}) * 100 AS HUGEINT) % 100 AS VARCHAR), 2, '0')"
    return f"{grow(part, 6, 'l')} || {cents}"


def money_or_spaces(c):
    return spaces_if_null(c, 8, money(c))


def flagged_money(flag, c):
    return (
        f"CASE WHEN {flag} = 'Y' THEN '00000000' WHEN {flag} = 'N' AND {c} IS NULL THEN '        ' "
        f"ELSE {money(c)} END"
    )


def offset(c, k):
    whole = f"regexp_replace({c}, '\\..*$', '')"
    return f"cast(try_cast({whole} AS DECIMAL(37,0)) + {k} AS VARCHAR)"


def hex11(c):
    return grow(f"coalesce(upper(to_hex(try_cast({clean(c)} AS BIGINT))), '')", 11)


def bare(c, default, blank_too=False, trim_first=False):
    inner = clean(f"ltrim({c})") if trim_first else f"ltrim({clean(c)})"
    test = f"{c} IS NULL OR {c} = ''" if blank_too else f"{c} IS NULL"
    return f"CASE WHEN {test} THEN '{default}' ELSE {inner} END"


def person(c, width):
    return spaces_if_null(c, width, text(c, width, null=None))
