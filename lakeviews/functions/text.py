"""Text column helpers: stripping, tokens, keyword tests, number formatting.

All are built-in column expressions (whole-stage codegen), applied to whole
texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: characters Python's str.strip() treats as white space ---
WHITESPACE_CLASS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}"
                    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

TOKEN_PATTERN = "[a-z_]+"


def fn_strip(c: Column) -> Column:
    """Trim every kind of white space at both ends (Spark ``trim`` strips blanks only)."""
    return F.regexp_replace(c, f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def fn_tokens(c: Column) -> Column:
    """Distinct ``[a-z_]+`` runs of the lower-cased text (an unordered set)."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), 0))


def fn_prefix(c: Column, *prefixes: str) -> Column:
    lowered = F.lower(c)
    out = F.lit(False)
    for p in prefixes:
        out = out | lowered.startswith(p)
    return out


def fn_lower_contains(text: Column, keyword: str) -> Column:
    """Case-folded substring test (not LIKE: a keyword may hold ``&`` or ``_``)."""
    return F.contains(F.lower(text), F.lit(keyword))


def fn_money_text(x: Column) -> Column:
    """``$`` + the value rounded half-to-even to a whole number, with thousands separators."""
    return F.concat(F.lit("$"), F.format_number(x.cast("double"), 0))


def fn_ratio_text(x: Column) -> Column:
    """One decimal, no thousands separator (as ``{x:.1f}``)."""
    return F.regexp_replace(F.format_number(x.cast("double"), 1), ",", "")


def fn_count_text(x: Column) -> Column:
    """Whole number with thousands separators (as ``{n:,}``)."""
    return F.format_number(x.cast("long"), 0)


def fn_thousandths_text(t: Column) -> Column:
    """Shortest decimal text of t / 1000 for integer thousandths t >= 0 (``1.5``, ``2.0``, ``0.125``)."""
    whole = (t - F.pmod(t, F.lit(1000))) / 1000
    frac = F.regexp_replace(F.lpad(F.pmod(t, F.lit(1000)).cast("string"), 3, "0"), "0+$", "")
    return F.concat(whole.cast("long").cast("string"), F.lit("."),
                    F.when(frac == "", F.lit("0")).otherwise(frac))


def fn_join_lines(lines_sorted: Column) -> Column:
    """Newline-join of an array of structs sorted by position, taking their ``line`` field."""
    return F.array_join(lines_sorted.getField("line"), "\n")


def fn_nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
