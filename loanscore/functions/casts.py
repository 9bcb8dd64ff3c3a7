"""Null-on-failure casts for dirty text.

The raw file carries numbers and months as text, some of it malformed.
Spark 4 runs with ANSI on, where a plain ``cast`` of bad text raises, so
every conversion of raw text goes through one of these helpers, which
keep the lenient meaning: a value that does not parse becomes null.
All of them are built-in expressions, so they stay inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Text accepted as an integer: optional sign, digits, optional fraction
# (truncated; the digits before it may be missing), surrounding blanks and
# control characters. '1e3' or '5d' are rejected.
BLANK = r"[\x00-\x20\x7F]*"
INT_TEXT = rf"^{BLANK}[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*){BLANK}$"
INT_PART = rf"^{BLANK}([+-]?[0-9]*)"

MONTH_FORMAT = "MMM-yyyy"


def _q(name: str) -> str:
    """A column name, or SQL expression text, ready to embed in SQL."""
    return f"`{name}`" if name.isidentifier() else f"({name})"


def int_trunc_sql(text: str, to: str = "INT") -> str:
    """SQL text of ``to_int_trunc`` for a text-valued column name or expression.

    'd...d.0' (how counts are usually written) parses its integer part
    directly, skipping the regular expression; anything else goes through
    the plain-decimal check, and what stands before the point is read
    (nothing, or a sign alone, is 0). Nothing is cast before a cheap check
    has passed: a failing cast is slow (it raises internally).
    """
    x = _q(text)
    whole = f"substring({x}, 1, length({x}) - 2)"
    part = f"regexp_extract({x}, r'{INT_PART}', 1)"
    return (
        f"CASE WHEN endswith({x}, '.0') AND substring({x}, -3, 1) BETWEEN '0' AND '9' "
        f"THEN try_cast({whole} AS {to}) "
        f"WHEN {x} RLIKE r'{INT_TEXT}' THEN CASE WHEN {part} IN ('', '+', '-') THEN CAST(0 AS {to}) "
        f"ELSE try_cast({part} AS {to}) END END"
    )


def to_double(c: Column | str) -> Column:
    """Text or number to double; malformed text gives null."""
    if isinstance(c, str):
        return F.expr(f"try_cast({_q(c)} AS DOUBLE)")
    return c.try_cast("double")


def to_double_2(c: Column | str) -> Column:
    """Text or number to double rounded to two decimals."""
    if isinstance(c, str):
        return F.expr(f"round(try_cast({_q(c)} AS DOUBLE), 2)")
    return F.round(to_double(c), 2)


def to_int_trunc(c: Column | str, source_type: DataType | None = None) -> Column:
    """Text or number to int, truncating any fraction ('2.9' -> 2).

    Numbers are cast directly (overflow gives null). Text must look like a
    plain decimal first; its integer part is then read. A string argument is
    a column name or SQL expression text.
    """
    return _truncated(c, source_type, "INT")


def to_long_trunc(c: str, source_type: DataType | None = None) -> Column:
    """As ``to_int_trunc``, to bigint: for ranking by ids of any size."""
    return _truncated(c, source_type, "BIGINT")


def _truncated(c: Column | str, source_type: DataType | None, to: str) -> Column:
    numeric = source_type is not None and not isinstance(source_type, StringType)
    if isinstance(c, str):
        return F.expr(f"try_cast({_q(c)} AS {to})" if numeric else int_trunc_sql(c, to))
    if numeric:
        return c.try_cast(to.lower())
    part = F.regexp_extract(c, INT_PART, 1)
    whole = F.when(part.isin("", "+", "-"), F.lit(0)).otherwise(part.try_cast(to.lower()))
    return F.when(c.rlike(INT_TEXT), whole)


def to_month_date(c: Column | str) -> Column:
    """'Dec-2015' -> 2015-12-01; anything else -> null."""
    if isinstance(c, str):
        return F.expr(f"try_to_date({_q(c)}, '{MONTH_FORMAT}')")
    return F.try_to_date(c, MONTH_FORMAT)


def int_digits(c: str) -> Column:
    """The digits of an int column as text: the same as dropping every
    non-digit character from its decimal text (only a '-' can occur), without
    a regular expression."""
    return F.expr(f"CAST(abs(CAST({_q(c)} AS BIGINT)) AS STRING)")


def digits_only(c: Column | str) -> Column:
    """Drop every non-digit character; the result is text."""
    if isinstance(c, str):
        return F.expr(f"regexp_replace(CAST({_q(c)} AS STRING), r'\\D', '')")
    return F.regexp_replace(c.cast("string"), r"\D", "")
