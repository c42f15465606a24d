"""Date expressions: multi-format parsing and month keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DATE_DAY_MONTH, DATE_DIGITS, DATE_MONTH_FIRST, DATE_TIME, DATE_YEAR_FIRST, DATE_YEAR_LAST, MONTHS_SHORT
from .text import col_


def day_first_votes(c: Column | str) -> tuple[Column, Column]:
    """Whether a cell can be read with the day first, and with the month first
    (only cells whose year stands last can)."""
    x = col_(c)
    fits = x.rlike(DATE_YEAR_LAST + DATE_TIME + "$")
    a, b = (F.when(fits, F.regexp_extract(x, DATE_YEAR_LAST, i)).cast("int") for i in (1, 3))
    return F.coalesce(a.between(1, 31) & b.between(1, 12), F.lit(False)), F.coalesce(a.between(1, 12) & b.between(1, 31), F.lit(False))


def parse_date_iso(c: Column | str, formats: list[str] | None = None, day_first: Column | None = None) -> Column:
    """The day of a date as ``yyyy-MM-dd``; unparseable text becomes null. With
    own ``formats`` the text is parsed with these (first match wins). Otherwise
    every known style is read: the year first (with ``-``, ``/``, ``.`` or
    nothing between), the year last (``day_first`` says which number is the day;
    the month comes first without it; of a two-digit year 69-99 are 19xx), and
    English month names; a time of 24 or 12 hours and a zone may follow.

    The shape of a text decides which style it is tried as, so that each text
    meets one long pattern at most; the plain form meets none."""
    x = col_(c)
    if formats is not None:
        tries = [F.try_to_timestamp(x, F.lit(f)) for f in formats]
        return F.date_format(F.to_date(F.coalesce(*tries) if len(tries) > 1 else tries[0]), "yyyy-MM-dd")

    # the year last: its century is put before two digits
    numbers = DATE_YEAR_LAST + DATE_TIME + "$"
    y = F.regexp_replace(x, numbers, "$4-$1-$3")
    if day_first is not None:
        y = F.when(day_first, F.regexp_replace(x, numbers, "$4-$3-$1")).otherwise(y)
    last = F.when(F.substring(y, 3, 1) != "-", y).otherwise(F.concat(F.when(y >= "69", F.lit("19")).otherwise(F.lit("20")), y))
    # the month's name is looked for at its place in the row of short names
    words = F.regexp_replace(F.lower(x), DATE_DAY_MONTH + DATE_TIME + "$", "$2 $1 $3")
    words = F.regexp_replace(words, DATE_MONTH_FIRST + DATE_TIME + "$", "$3-$1-$2")
    month = ((F.instr(F.lit(MONTHS_SHORT), F.substring(words, 6, 3)) + 2) / 3).cast("int").cast("string")
    named = F.concat_ws("-", F.substring(words, 1, 4), month, F.regexp_extract(words, r"-(\d{1,2})$", 1))
    text = (F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$"), x)
            .when(x.rlike(r"^\d{4}[-/.]"), F.regexp_replace(x, DATE_YEAR_FIRST + DATE_TIME + "$", "$1-$3-$4"))
            .when(x.rlike("[A-Za-z]{3}"), named)
            .when(x.rlike(r"^\d{8}"), F.regexp_replace(x, DATE_DIGITS + DATE_TIME + "$", "$1-$2-$3"))
            .otherwise(last))
    # a cast alone would let anything follow the day
    return F.regexp_extract(text, r"^\d{4}-\d{1,2}-\d{1,2}$", 0).try_cast("date").cast("string")


def month_key(c: Column | str) -> Column:
    """``YYYY-MM`` key of an ISO date string (its first seven characters)."""
    return F.substring(col_(c), 1, 7)


def month_ordinal(c: Column | str) -> Column:
    """year*12 + month-1 of a ``YYYY-MM`` key (for month arithmetic)."""
    k = col_(c)
    return F.substring(k, 1, 4).cast("int") * 12 + F.substring(k, 6, 2).cast("int") - 1


def ordinal_to_month(c: Column | str) -> Column:
    o = col_(c)
    y = F.floor(o / 12).cast("int")
    m = (o - y * 12 + 1).cast("int")
    return F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"))
