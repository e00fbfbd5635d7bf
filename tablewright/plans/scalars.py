"""Scalar function queries: every function over a whole table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions import scalar as s
from tablewright.plans.registry import register, table

_KEYS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "documents": ["doc_id"],
    "pages": ["page_id"],
    "events": ["event_id"],
    "labels": ["doc_id"],
    "customer": ["c_custkey"],
}


def _scalar(name: str, source: str, **outputs: tuple) -> None:
    """Register ``fn_<name>``: key columns and one column per (expression maker, SQL) pair."""
    keys = _KEYS[source]
    select = ", ".join([*keys, *[f"{sql} AS {k}" for k, (_, sql) in outputs.items()]])

    @register(f"fn_{name}", f"SELECT {select} FROM {source}")
    def run(spark, sf_dir):
        made = [make().alias(k) for k, (make, _) in outputs.items()]
        return table(spark, sf_dir, source).select(*keys, *made)


def _digest(text: Column) -> Column:
    return F.md5(text)


c = F.col

# --- operators

_scalar("pow", "lineitem", result=(lambda: s.power("l_quantity", 2), "POW(l_quantity, 2)"))
_scalar(
    "mod",
    "lineitem",
    result=(lambda: s.mod(c("l_orderkey") - c("l_partkey") * 9, 7), "(l_orderkey - l_partkey * 9) % 7"),
)
_scalar(
    "ifnull",
    "lineitem",
    result=(
        lambda: s.if_null(F.nullif("l_returnflag", F.lit("N")), "none"),
        "IFNULL(NULLIF(l_returnflag, 'N'), 'none')",
    ),
)

# --- type coercion

_scalar(
    "as_integer",
    "lineitem",
    result=(lambda: s.as_integer(c("l_quantity") / 2 - 12), "CAST(ROUND(l_quantity / 2 - 12) AS BIGINT)"),
    parsed=(
        lambda: s.as_integer(F.concat(F.lit("-"), c("l_partkey").cast("string"))),
        "CAST('-' || CAST(l_partkey AS VARCHAR) AS BIGINT)",
    ),
)
_scalar("as_numeric", "lineitem", result=(lambda: s.as_numeric("l_orderkey"), "CAST(l_orderkey AS DOUBLE)"))
_scalar(
    "as_double",
    "lineitem",
    result=(
        lambda: s.as_double(F.concat(c("l_linenumber").cast("string"), F.lit(".25"))),
        "CAST(CAST(l_linenumber AS VARCHAR) || '.25' AS DOUBLE)",
    ),
)
_scalar(
    "as_character",
    "orders",
    key_text=(lambda: s.as_character("o_orderkey"), "CAST(o_orderkey AS VARCHAR)"),
    date_text=(lambda: s.as_character(c("o_orderdate").cast("date")), "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"),
)
_scalar(
    "as_logical",
    "labels",
    number=(lambda: s.as_logical("quality"), "CAST(quality AS BOOLEAN)"),
    parsed=(
        lambda: s.as_logical(F.when(c("toxic") == 1, "TRUE").otherwise("false")),
        "CAST(CASE WHEN toxic = 1 THEN 'TRUE' ELSE 'false' END AS BOOLEAN)",
    ),
)
_scalar("as_date", "orders", result=(lambda: s.as_date("o_orderdate"), "CAST(o_orderdate AS DATE)"))
_scalar(
    "as_posixct",
    "events",
    result=(lambda: s.as_posixct(c("ts").cast("string")), "CAST(CAST(ts AS VARCHAR) AS TIMESTAMP)"),
)

# --- strings

_scalar("nchar", "documents", result=(lambda: s.nchar("text"), "LENGTH(text)"))
_scalar("tolower", "documents", result=(lambda: _digest(s.tolower("text")), "MD5(LOWER(text))"))
_scalar("toupper", "documents", result=(lambda: _digest(s.toupper("text")), "MD5(UPPER(REPLACE(text, 'ß', 'SS')))"))
_BLANK_SQL = "' ' || CHR(9) || CHR(10) || CHR(11) || CHR(12) || CHR(13) || CHR(160) || CHR(8195)"
_PADDED_SQL = "(CHR(9) || ' ' || CHR(160) || text || ' ' || CHR(10))"


def _padded() -> Column:
    return F.concat(F.lit("\t \xa0"), c("text"), F.lit(" \n"))


_scalar(
    "trimws",
    "documents",
    result=(lambda: _digest(s.trimws(_padded())), f"MD5(TRIM({_PADDED_SQL}, {_BLANK_SQL}))"),
)
_scalar(
    "paste",
    "documents",
    result=(
        lambda: s.paste("lang", F.nullif("lang", F.lit("en")), "source", sep="-"),
        "CONCAT_WS('-', lang, NULLIF(lang, 'en'), source)",
    ),
)
_scalar(
    "paste0",
    "documents",
    result=(lambda: s.paste0("source", F.nullif("lang", F.lit("en"))), "source || NULLIF(lang, 'en')"),
)
_scalar("substr", "documents", result=(lambda: s.substr("text", 3, 12), "SUBSTR(text, 3, 10)"))
_scalar(
    "substring",
    "documents",
    rest=(lambda: _digest(s.substring("text", 5)), "MD5(SUBSTR(text, 5))"),
    part=(lambda: s.substring("text", 5, 14), "SUBSTR(text, 5, 10)"),
)
_scalar("str_detect", "documents", result=(lambda: s.str_detect("text", r"\d{3,}"), r"REGEXP_MATCHES(text, '\d{3,}')"))
_scalar(
    "str_extract",
    "pages",
    title=(
        lambda: s.str_extract("html", r"<title>([^<]*)</title>"),
        "CASE WHEN REGEXP_MATCHES(html, '<title>([^<]*)</title>') "
        "THEN REGEXP_EXTRACT(html, '<title>([^<]*)</title>', 1) END",
    ),
    number=(
        lambda: s.str_extract("html", r"[0-9]{2,}"),
        "CASE WHEN REGEXP_MATCHES(html, '[0-9]{2,}') THEN REGEXP_EXTRACT(html, '[0-9]{2,}') END",
    ),
)
_scalar(
    "str_replace",
    "documents",
    result=(
        lambda: _digest(s.str_replace("text", r"([aeiou])([lnr])", r"\2$\1")),
        r"MD5(REGEXP_REPLACE(text, '([aeiou])([lnr])', '\2$\1', 'g'))",
    ),
)
_scalar(
    "str_replace_all",
    "pages",
    result=(lambda: _digest(s.str_replace_all("html", "<[^>]+>", " ")), "MD5(REGEXP_REPLACE(html, '<[^>]+>', ' ', 'g'))"),
)
_scalar(
    "str_trim",
    "documents",
    both=(lambda: _digest(s.str_trim(_padded())), f"MD5(TRIM({_PADDED_SQL}, {_BLANK_SQL}))"),
    left_side=(lambda: _digest(s.str_trim(_padded(), "left")), f"MD5(LTRIM({_PADDED_SQL}, {_BLANK_SQL}))"),
    right_side=(lambda: _digest(s.str_trim(_padded(), "right")), f"MD5(RTRIM({_PADDED_SQL}, {_BLANK_SQL}))"),
)
_scalar("str_to_lower", "pages", result=(lambda: _digest(s.str_to_lower("html")), "MD5(LOWER(html))"))
_scalar("str_to_upper", "customer", result=(lambda: s.str_to_upper("c_name"), "UPPER(c_name)"))
_TITLE_SPLIT = "[\\s" + "".join("\\" + d for d in s.TITLE_DELIMITERS) + "]"
_NO_SPLIT = "[^\\s" + _TITLE_SPLIT[3:]
_TITLE_SQL = (
    f"MD5(ARRAY_TO_STRING(LIST_TRANSFORM(REGEXP_EXTRACT_ALL(LOWER(text), '{_NO_SPLIT}*{_TITLE_SPLIT}|{_NO_SPLIT}+'), "
    "LAMBDA w: UPPER(REPLACE(w[1], 'ß', 'SS')) || w[2:]), ''))"
)
_scalar("str_to_title", "documents", result=(lambda: _digest(s.str_to_title("text")), _TITLE_SQL))
_scalar("str_c", "customer", result=(lambda: s.str_c("c_mktsegment", F.lit("/"), "c_name"), "c_mktsegment || '/' || c_name"))
_scalar("str_length", "pages", result=(lambda: s.str_length("html"), "LENGTH(html)"))
_scalar(
    "str_sub",
    "documents",
    whole=(lambda: _digest(s.str_sub("text")), "MD5(text)"),
    inner_part=(lambda: _digest(s.str_sub("text", 2, -3)), "MD5(SUBSTR(text, 2, GREATEST(LENGTH(text) - 3, 0)))"),
    tail=(lambda: s.str_sub("text", -4, -2), "CASE WHEN LENGTH(text) >= 4 THEN SUBSTR(text, LENGTH(text) - 3, 3) "
          "ELSE SUBSTR(text, 1, GREATEST(LENGTH(text) - 1, 0)) END"),
)
_scalar("grepl", "pages", result=(lambda: s.grepl("^https://", "url"), "REGEXP_MATCHES(url, '^https://')"))
_scalar(
    "gsub",
    "pages",
    result=(lambda: s.gsub(r"^(\w+)://", r"\1:", "url"), r"REGEXP_REPLACE(url, '^(\w+)://', '\1:', 'g')"),
)
_scalar("sub", "pages", result=(lambda: s.sub("[.]", "_", "url"), "REGEXP_REPLACE(url, '[.]', '_', 'g')"))

# --- conditional

_scalar(
    "ifelse",
    "lineitem",
    result=(
        lambda: s.ifelse(F.nullif("l_linestatus", F.lit("O")) == "F", "filled", "open or unknown"),
        "CASE WHEN NULLIF(l_linestatus, 'O') = 'F' THEN 'filled' ELSE 'open or unknown' END",
    ),
)
_scalar(
    "coalesce",
    "lineitem",
    result=(
        lambda: s.coalesce(F.nullif("l_returnflag", F.lit("N")), F.nullif("l_linestatus", F.lit("O")), F.lit("?")),
        "COALESCE(NULLIF(l_returnflag, 'N'), NULLIF(l_linestatus, 'O'), '?')",
    ),
)
_scalar(
    "pmax",
    "lineitem",
    result=(
        lambda: s.pmax("l_quantity", F.nullif("l_tax", F.lit(0.0)) * 500),
        "CASE WHEN NULLIF(l_tax, 0.0) IS NOT NULL THEN GREATEST(l_quantity, l_tax * 500) END",
    ),
)
_scalar(
    "pmin",
    "lineitem",
    result=(
        lambda: s.pmin("l_quantity", F.nullif("l_tax", F.lit(0.0)) * 500),
        "CASE WHEN NULLIF(l_tax, 0.0) IS NOT NULL THEN LEAST(l_quantity, l_tax * 500) END",
    ),
)

# --- date and time

_scalar("sys_date", "events", past=(lambda: c("ts").cast("date") <= s.sys_date(), "CAST(ts AS DATE) <= CURRENT_DATE"))
_scalar(
    "sys_time",
    "events",
    past=(lambda: c("ts") <= s.sys_time().cast("timestamp_ntz"), "ts <= CAST(CURRENT_TIMESTAMP AS TIMESTAMP)"),
)

# --- math and rounding

_scalar(
    "log",
    "lineitem",
    natural=(lambda: F.round(s.log("l_extendedprice"), 8), "ROUND(LN(l_extendedprice), 8)"),
    base_ten=(lambda: F.round(s.log("l_extendedprice", 10), 8), "ROUND(LOG10(l_extendedprice), 8)"),
    base_three=(lambda: F.round(s.log("l_extendedprice", 3), 8), "ROUND(LN(l_extendedprice) / LN(3), 8)"),
)
_scalar("log10", "lineitem", result=(lambda: F.round(s.log10("l_quantity"), 8), "ROUND(LOG10(l_quantity), 8)"))
_scalar("log2", "lineitem", result=(lambda: F.round(s.log2("l_quantity"), 8), "ROUND(LOG2(l_quantity), 8)"))
_scalar(
    "round",
    "lineitem",
    whole=(lambda: s.round_("l_extendedprice"), "ROUND(l_extendedprice)"),
    halves=(lambda: s.round_(c("l_quantity") / 2 - 12), "ROUND(l_quantity / 2 - 12)"),
    hundreds=(lambda: s.round_("l_extendedprice", -2), "ROUND(l_extendedprice, -2)"),
)
_scalar("floor", "customer", result=(lambda: s.floor("c_acctbal"), "FLOOR(c_acctbal)"))
_scalar("ceiling", "customer", result=(lambda: s.ceiling("c_acctbal"), "CEIL(c_acctbal)"))

_scalar(
    "floor_large",
    "customer",
    large=(lambda: s.floor(c("c_acctbal") * 1e16), "FLOOR(c_acctbal * 1e16)"),
    ceiling=(lambda: s.ceiling(c("c_acctbal") * 1e300), "CEIL(c_acctbal * 1e300)"),
)

# --- inherited

_scalar(
    "math_basic",
    "lineitem",
    total=(
        lambda: c("l_extendedprice") * (1 - c("l_discount")) + c("l_tax"),
        "l_extendedprice * (1 - l_discount) + l_tax",
    ),
    ratio=(lambda: c("l_extendedprice") / c("l_quantity"), "l_extendedprice / l_quantity"),
    absolute=(lambda: F.abs(c("l_quantity") - 25), "ABS(l_quantity - 25)"),
    signum=(lambda: F.signum(c("l_quantity") - 25).cast("int"), "CAST(SIGN(l_quantity - 25) AS INTEGER)"),
    root=(lambda: F.round(F.sqrt("l_quantity"), 8), "ROUND(SQRT(l_quantity), 8)"),
    exponential=(lambda: F.round(F.exp("l_discount"), 8), "ROUND(EXP(l_discount), 8)"),
    wave=(
        lambda: F.round(F.sin("l_quantity") + F.cos("l_tax") + F.atan("l_discount"), 8),
        "ROUND(SIN(l_quantity) + COS(l_tax) + ATAN(l_discount), 8)",
    ),
    bits=(
        lambda: c("l_orderkey").bitwiseAND(255).bitwiseXOR(c("l_partkey")),
        "XOR(l_orderkey & 255, l_partkey)",
    ),
)
_scalar(
    "date_parts",
    "events",
    y=(lambda: F.year("ts"), "CAST(YEAR(ts) AS INTEGER)"),
    q=(lambda: F.quarter("ts"), "CAST(QUARTER(ts) AS INTEGER)"),
    m=(lambda: F.month("ts"), "CAST(MONTH(ts) AS INTEGER)"),
    w=(lambda: F.weekofyear("ts"), "CAST(WEEK(ts) AS INTEGER)"),
    d=(lambda: F.dayofmonth("ts"), "CAST(DAY(ts) AS INTEGER)"),
    weekday=(lambda: F.dayofweek("ts"), "CAST(DAYOFWEEK(ts) + 1 AS INTEGER)"),
    yearday=(lambda: F.dayofyear("ts"), "CAST(DAYOFYEAR(ts) AS INTEGER)"),
    h=(lambda: F.hour("ts"), "CAST(HOUR(ts) AS INTEGER)"),
    minute_of_hour=(lambda: F.minute("ts"), "CAST(MINUTE(ts) AS INTEGER)"),
    day_start=(lambda: F.date_trunc("day", "ts").cast("timestamp_ntz"), "CAST(DATE_TRUNC('day', ts) AS TIMESTAMP)"),
)
