"""Type coercion of raw string columns to the contract's logical types.

Every rule turns a bad value into NULL instead of failing the job:

  date    the whole text must be year-month-day, as 2024-1-5, with or without a
          time of day (dropped); anything after it -> NULL
  int     integral text -> BIGINT, every digit kept; "10.0" -> 10; "1.5" -> NULL
  float   decimal / scientific text -> DOUBLE; Java suffixes such as "1.0d",
          words such as "NaN" or "inf" and numbers beyond DOUBLE -> NULL
  bool    lower-cased value in {true, 1, yes}; anything else, NULL included,
          -> false
  string  unchanged (values are read as text, so leading zeros survive)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeviews.contracts import Contract

# Plain decimal or scientific notation, optional sign, surrounding blanks allowed.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Decimal notation of at most 300 digits before the point, which is never beyond DOUBLE.
PLAIN_PATTERN = r"^\s*+[+-]?+\d{1,300}+(?:\.\d*+)?+\s*+\z"

# What a cast to BIGINT takes (control characters at the ends too), and whole numbers
# as a float column prints them.  A cast that fails raises and catches an exception
# for each value, some 30 us, so text goes only to a cast that takes it.
WHOLE_PATTERN = r"^[\x00-\x20\x7f]*[+-]?\d+[\x00-\x20\x7f]*\z"
POINT_ZERO_PATTERN = r"^\s*[+-]?\d{1,18}\.0{0,18}\s*\z"

DATE_PATTERN = (r"^\s*\d{4}-\d{1,2}-\d{1,2}"
                r"([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?\s*(Z|[+-]\d{1,2}:?\d{2})?)?\s*$")

# --- Fixed values: text accepted as true ---
TRUE_WORDS = ["true", "1", "yes"]


def coerce_date(c: Column) -> Column:
    return F.when(c.rlike(DATE_PATTERN), F.trim(c).try_cast("date"))


def coerce_float(c: Column) -> Column:
    d = F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))
    # Plain text is matched and cast once; the general form names ``d`` twice and computes it twice.
    return F.when(c.rlike(PLAIN_PATTERN), F.trim(c).try_cast("double")).when(F.abs(d) < F.lit(float("inf")), d)


def coerce_int(c: Column) -> Column:
    # 20 digits before the point hold every BIGINT; the text is never read as a double.
    exact = F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("decimal(38,18)"))
    return (F.when(c.rlike(WHOLE_PATTERN), F.trim(c).try_cast("long"))
            .when(c.rlike(POINT_ZERO_PATTERN), F.substring_index(c, ".", 1).try_cast("long"))
            .when(exact == F.floor(exact), exact.try_cast("long")))


def coerce_bool(c: Column) -> Column:
    return F.coalesce(F.lower(c).isin(*TRUE_WORDS), F.lit(False))


def coerce_string(c: Column) -> Column:
    return c.cast("string")


COERCERS = {
    "date": coerce_date,
    "int": coerce_int,
    "float": coerce_float,
    "bool": coerce_bool,
    "string": coerce_string,
}


def coerce_column(c: Column, logical_type: str) -> Column:
    return COERCERS[logical_type](c)


def coerce_types(df: DataFrame, contract: Contract) -> DataFrame:
    """Apply the contract to every declared column present; keep undeclared ones as they are."""
    return df.select(*[coerce_column(F.col(f"`{c}`"), contract.columns[c]).alias(c) if c in contract.columns else F.col(f"`{c}`")
                       for c in df.columns])
