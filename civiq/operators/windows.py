"""Counts of reports in windows of days.

Reports are counted once per day; a window is then the running sum at its end
minus the running sum before its start. Both values come from one union of the
days with the windows' two ends, sorted by day: the sum so far is the last value
at or before each end. A window costs two rows, whatever its length; ends are
compared as text, as the filters do, so they need not be days of the calendar.

The month with most reports comes from a sparse table: the best month of every
block of 1, 2, 4, ... months. The whole months of a window are covered by two
blocks; its broken first and last month are windows of days of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_ordinal, ordinal_to_month

#: Open ends, before and behind every date. Rows without a date stand before all
#: others and count in a window that is open on both sides alone.
NO_DATE, FIRST, LAST = "", "\x01", "\uffff"
#: Copies of the days of one key, so that its windows are spread.
COPIES = 8
_BEFORE, _DAY, _BEHIND = 0, 1, 2


def ends(desde: Column, hasta: Column) -> tuple[Column, Column]:
    """A window's ends; null and empty ones are open."""
    start, end = F.nullif(desde, F.lit("")), F.nullif(hasta, F.lit(""))
    return F.coalesce(start, F.when(end.isNull(), F.lit(NO_DATE)).otherwise(F.lit(FIRST))), F.coalesce(end, F.lit(LAST))


def window_counts(days: DataFrame, windows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """days(*keys, fecha, n, n_urg); windows(wkey, *keys, desde, hasta) with both
    ends. Returns (wkey, *keys, n, n_urg), zeros included."""
    copy = F.pmod(F.xxhash64("wkey"), F.lit(COPIES)).cast("int")
    zero = F.lit(0).cast("long")
    edge = F.explode(F.array(F.struct(F.col("desde").alias("fecha"), F.lit(_BEFORE).alias("kind")),
                             F.struct(F.col("hasta").alias("fecha"), F.lit(_BEHIND).alias("kind"))))
    asked = windows.select("wkey", *keys, copy.alias("_copy"), edge.alias("_e")).select(
        "wkey", *keys, "_copy", "_e.fecha", "_e.kind", zero.alias("n"), zero.alias("n_urg"))
    known = days.select(F.lit(None).cast("string").alias("wkey"), *keys, F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("_copy"),
                        "fecha", F.lit(_DAY).alias("kind"), F.col("n").cast("long").alias("n"), F.col("n_urg").cast("long").alias("n_urg"))
    so_far = Window.partitionBy(*keys, "_copy").orderBy("fecha", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = asked.unionByName(known).select("wkey", *keys, "kind", F.sum("n").over(so_far).alias("n"), F.sum("n_urg").over(so_far).alias("n_urg"))
    sign = F.when(F.col("kind") == _BEHIND, F.lit(1)).otherwise(F.lit(-1))
    # a window that ends before it starts holds nothing
    return (summed.where(F.col("kind") != _DAY).groupBy("wkey", *keys)
            .agg(*[F.greatest(F.sum(sign * F.col(c)), F.lit(0)).alias(c) for c in ("n", "n_urg")]))


def month_blocks(months: DataFrame) -> tuple[DataFrame, int, int] | None:
    """months(mes, n) -> (level, ord, best): the best month, as (-n, mes), of the
    2**level months from ord on; and the first and last month's number. None if
    there is no month. A row per month and level at most."""
    numbered = months.where(F.col("mes").rlike(r"^\d{4}-\d{2}$")).select(month_ordinal("mes").alias("ord"), F.struct((-F.col("n")).alias("neg"), "mes").alias("own"))
    low, high = numbered.agg(F.min("ord"), F.max("ord")).head()
    if low is None:
        return None
    every = months.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("ord"))
    dense = every.join(numbered, "ord", "left")
    levels = range((high - low + 1).bit_length())
    # one sort of at most 12 rows a year
    wide = dense.select("ord", *[F.min("own").over(Window.orderBy("ord").rangeBetween(0, 2**j - 1)).alias(f"b{j}") for j in levels])
    blocks = [F.struct(F.lit(j).alias("level"), F.col(f"b{j}").alias("best")) for j in levels]
    return wide.select("ord", F.explode(F.array(*blocks)).alias("b")).select("b.level", "ord", "b.best").where("best IS NOT NULL"), low, high


def _month(end: Column, first: bool) -> Column:
    """Number of the first month that can hold days from `end` on, or of the
    last that can hold days up to it; null for an open end."""
    year, month = F.substring(end, 1, 4).try_cast("int"), F.coalesce(F.substring(end, 6, 2).try_cast("int"), F.lit(0))
    if first:
        return F.when(month < 1, year * 12).when(month <= 12, year * 12 + month - 1).otherwise((year + 1) * 12)
    return F.when(month > 12, year * 12 + 11).when(month >= 1, year * 12 + month - 1).otherwise(year * 12 - 1)


def peak_months(days: DataFrame, windows: DataFrame) -> DataFrame:
    """days(fecha, n, n_urg), windows(wkey, desde, hasta) -> (wkey, mes, n): the
    month with most reports inside each window, the earliest on ties."""
    months = days.groupBy(F.substring("fecha", 1, 7).alias("mes")).agg(F.sum("n").alias("n"))
    found = month_blocks(months)
    if found is None:
        return windows.select("wkey", F.lit("").alias("mes"), F.lit(0).cast("long").alias("n")).limit(0)
    blocks, low, high = found
    w = windows.select("wkey", "desde", "hasta", F.coalesce(_month(F.col("desde"), True), F.lit(low)).alias("s"), F.coalesce(_month(F.col("hasta"), False), F.lit(high)).alias("e"))
    w = w.where("s <= e").withColumns({"sm": ordinal_to_month("s"), "em": ordinal_to_month("e")})
    w = w.withColumns({"s_cut": F.col("desde") > F.concat("sm", F.lit("-01")), "e_cut": F.col("hasta") < F.concat("em", F.lit("-31"))})
    # broken months at the edges, as windows of days
    month = [F.when(F.col("s_cut"), F.struct(F.col("sm").alias("mes"), F.col("desde"), F.least("hasta", F.concat("sm", F.lit("-31"))).alias("hasta"))),
             F.when(F.col("e_cut") & ~(F.col("s_cut") & (F.col("s") == F.col("e"))),
                    F.struct(F.col("em").alias("mes"), F.greatest("desde", F.concat("em", F.lit("-01"))).alias("desde"), F.col("hasta")))]
    broken = w.select("wkey", F.explode(F.array_compact(F.array(*month))).alias("m")).select(F.concat_ws("\t", "m.mes", "wkey").alias("wkey"), "m.desde", "m.hasta")
    edges = window_counts(days, broken).where("n > 0").select(
        F.expr("substring(wkey, 9)").alias("wkey"), F.struct((-F.col("n")).alias("neg"), F.substring("wkey", 1, 7).alias("mes")).alias("best"))
    # whole months: two blocks that cover them
    whole = w.select("wkey", F.greatest(F.col("s") + F.col("s_cut").cast("int"), F.lit(low)).alias("a"), F.least(F.col("e") - F.col("e_cut").cast("int"), F.lit(high)).alias("b")).where("a <= b")
    # half a month more keeps the logarithm of a whole power from rounding down
    whole = whole.withColumn("level", F.floor(F.log2(F.col("b") - F.col("a") + F.lit(1.5))).cast("int"))
    looked = whole.select("wkey", "level", F.explode(F.array(F.col("a"), F.col("b") - F.pow(F.lit(2), F.col("level")).cast("int") + 1)).alias("ord"))
    inner = looked.join(blocks, ["level", "ord"]).select("wkey", "best")
    both = reduce(DataFrame.unionByName, [edges, inner])
    return both.groupBy("wkey").agg(F.min("best").alias("b")).select("wkey", F.col("b.mes").alias("mes"), (-F.col("b.neg")).alias("n"))
