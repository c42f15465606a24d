"""Guarded numeric coercion of dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# Plain decimal or exponent notation. Spark's try_cast would also accept
# suffixed literals such as "1d" and the words inf/nan, which are rejected.
NUMERIC_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def to_number(c: Column | str) -> Column:
    """Text to double, or null when the text is not a plain number."""
    x = col_(c)
    return F.when(x.rlike(NUMERIC_PATTERN), x.try_cast("double"))


# A whole number, also written with empty decimals ("7.0").
WHOLE_PATTERN = r"^[+-]?\d+(\.0*)?$"
# Whole numbers from here on do not fit a 64-bit integer.
LONG_LIMIT = 9.2e18


def to_long(c: Column | str) -> Column:
    """Text to a 64-bit integer: whole numbers are read digit by digit (no
    rounding through double), other numbers are truncated; numbers that do not
    fit are null."""
    x, n = col_(c), to_number(c)
    return (F.when(x.rlike(WHOLE_PATTERN), F.regexp_replace(x, r"\.0*$", "").try_cast("bigint"))
            .when(F.abs(n) < LONG_LIMIT, n.cast("bigint")))


def to_int_half_even(c: Column | str) -> Column:
    """Text to a number rounded half to even (so -0.5 -> 0 and 120.5 -> 120)."""
    return F.bround(to_number(c), 0)


def to_flag(c: Column | str) -> Column:
    """Text to a 0/1 integer flag; any other value (2, 0.5, True) is null."""
    n = to_number(c)
    return F.when(n.isin(0.0, 1.0), n.cast("int"))
