"""CSV source of raw reports (A1) and file sinks (A2, A3).

Reading splits files of any size, also where quoted values hold line breaks. The
parity of the quotes before a line says whether the line starts inside a quoted
value: quotes are counted per split (one row each), a running sum over the splits
of a file gives the parity at which each split starts, and inside a split a
running sum over its lines says where its records start. A split cuts its own
records; only the piece of a record that a split's edge breaks (two per split at
most) meets its other pieces. A split that starts outside a quoted value and whose
lines all hold an even number of quotes has a record in every line: it is cut
without a shuffle or a sort. Records are parsed after that, each on its own.
"""

from __future__ import annotations

import csv as stdlib_csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import SEQ, mark_na
from ..schema import COLUMN_RENAME_MAP
from ..session import materialize

_PLACE = ["file", "block"]
_SEQ_TYPE = "struct<file: string, block: bigint, row: bigint>"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, value): every line with its place (row grows inside a
    split); a carriage return at its end stays."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), "value")


def _quotes(value: str) -> Column:
    return F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def _names(header: str) -> list[str]:
    """Column names of a header line; a name that repeats gets a number."""
    names: list[str] = []
    for name in next(stdlib_csv.reader([header])):
        n, new = 0, name
        while new in names:
            n, new = n + 1, f"{name}.{n + 1}"
        names.append(new)
    return names


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: the parity that it starts with, the file's header line,
    whether every line is a record, and its first and last row."""
    counted = materialize(lines.groupBy(*_PLACE).agg(
        F.sum(_quotes("value")).alias("quotes"), F.min_by("value", "row").alias("first"),
        F.count_if(_quotes("value") % 2 == 1).alias("odd"), F.min("row").alias("first_row"), F.max("row").alias("last_row")))
    before = Window.partitionBy("file").orderBy("block")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    found = counted.select(
        *_PLACE, "odd", "first_row", "last_row", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("parity"),
        F.regexp_replace(F.first("first").over(before), "\r$", "").alias("header"))
    return found.withColumn("by_line", (F.col("parity") == 0) & (F.col("odd") == 0)).drop("odd")


_ANEW = "the files were split anew between two passes"


def _placed(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Lines with what is known of their split. Both passes must cut the files
    alike; a line of an unknown split ends the job."""
    same = F.coalesce("parity", F.raise_error(F.lit(_ANEW)).cast("long"))
    return lines.join(splits, _PLACE, "left").withColumn("parity", same)


def _records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, block, row, header, record): all records but the headers, at the
    place of their first line."""
    # one row per split, far fewer than the lines that would be shuffled else
    placed = _placed(lines, F.broadcast(splits))
    simple = _line_records(placed.where(F.coalesce("by_line", F.lit(True))))  # those of unknown splits end there
    if splits.where("NOT by_line").isEmpty():
        return simple
    return simple.unionByName(_quoted_records(placed.where("NOT by_line")))


def _line_records(placed: DataFrame) -> DataFrame:
    """Every line but the headers as a record. A header is the first row of its
    file; rows are numbered alike in both passes, or the job ends. That is looked at
    in every row, also in those that go: the filter is not moved below."""
    first = (F.col("block") == 0) & (F.col("row") == F.col("first_row"))
    alike = F.col("row").between(F.col("first_row"), F.col("last_row")) & (~first | (F.regexp_replace("value", "\r$", "") == F.col("header")))
    row = F.when(alike, F.col("row")).otherwise(F.raise_error(F.lit(_ANEW)).cast("long"))
    checked = placed.select(F.inline(F.array(F.struct(
        *_PLACE, row.alias("row"), "header", F.col("value").alias("record"), F.coalesce(first, F.lit(False)).alias("is_header")))))
    return _unended(checked.where(~F.col("is_header")).drop("is_header"))


def _quoted_records(placed: DataFrame) -> DataFrame:
    """The records of splits in which a line starts or ends inside a quoted value."""
    inside = Window.partitionBy(*_PLACE).orderBy("row")
    to_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("own", _quotes("value"))
    # the parity behind a line; with its own quotes that before it
    behind = (F.col("parity") + F.sum("own").over(to_here)) % 2
    cut = placed.withColumn("behind", behind).withColumn("number", F.row_number().over(inside))
    cut = cut.where((F.col("block") > 0) | (F.col("number") > 1)).withColumn("starts", (F.col("behind") + F.col("own")) % 2 == 0)
    cut = cut.withColumn("start", F.last(F.when(F.col("starts"), F.col("row")), ignorenulls=True).over(to_here))
    lines_in_order = F.sort_array(F.collect_list(F.struct("row", "value")))
    pieces = cut.groupBy(*_PLACE, "header", "start").agg(
        F.array_join(F.transform(lines_in_order, lambda x: x["value"]), "\n").alias("piece"),
        (F.max_by("behind", "row") == 1).alias("open"), F.min("row").alias("row"))
    whole = pieces.where(F.col("start").isNotNull() & ~F.col("open")).select(*_PLACE, "row", "header", F.col("piece").alias("record"))
    # pieces at the edges of splits: a head has no start, a tail is left open
    broken = pieces.where(F.col("start").isNull() | F.col("open"))
    order = Window.partitionBy("file").orderBy(*_PLACE, "row")
    at = F.last(F.when(F.col("start").isNotNull(), F.struct("block", "row")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = broken.withColumn("at", at).groupBy("file", "header", "at").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "row", "piece"))), lambda x: x["piece"]), "\n").alias("record"))
    both = whole.unionByName(joined.select("file", "at.block", "at.row", "header", "record"))
    return _unended(both)


def _unended(records: DataFrame) -> DataFrame:
    """Records without the carriage return at their end; blank lines go."""
    return records.withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.trim("record") != "")


def _single_lines(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Every line but the headers as a record."""
    placed = _placed(lines, splits).withColumn("number", F.row_number().over(Window.partitionBy(*_PLACE).orderBy("row")))
    return _unended(placed.where((F.col("block") > 0) | (F.col("number") > 1)).select(*_PLACE, "row", "header", F.col("value").alias("record")))


def _parsed(records: DataFrame, headers: list[str]) -> DataFrame:
    """Records as columns, by the names of their own file's header. A record is
    parsed once, in a projection of its own: in one with the columns it would be
    parsed again for each of them."""
    names: list[str] = []
    for h in headers:
        names += [n for n in _names(h) if n not in names]
    options = {"escape": '"', "mode": "PERMISSIVE"}
    parsed, holders = [], {n: [] for n in names}
    for i, h in enumerate(headers):
        own = _names(h)
        value = F.from_csv(F.col("record"), ", ".join(f"`{n.replace('`', '``')}` STRING" for n in own), options)
        parsed.append(F.when(F.col("header") == h, value).alias(f"_v{i}"))
        for n in own:
            holders[n].append(F.col(f"_v{i}")[n])
    rows = records.select(*parsed, F.struct("file", "block", "row").alias(SEQ))
    return rows.select(*[F.coalesce(*holders[n]).alias(n) for n in names], SEQ)


def read_reports_csv(spark: SparkSession, path: str, multiline: bool = True, split_bytes: int | None = None) -> DataFrame:
    """Read raw report CSV: UTF-8, header, every column as text, matched by
    header name in every file (files may order their columns differently; a
    column that a file lacks is null), NA markers -> null, plus a ``seq``
    arrival order (file, block, row) for first/last-row-wins rules.

    Files are split, also where quoted values hold line breaks (doubled quotes
    are allowed; a quote inside an unquoted value is not, as everywhere in the
    format). ``multiline=False`` takes every line as a record and skips that
    work. All headers are read in one job; a header is one line. The cut records
    are written once, so later passes need not cut again. ``split_bytes`` sets
    the size of the splits. A folder without files gives an empty table of the
    known columns."""
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    if split_bytes:
        spark.conf.set(size, str(split_bytes))
    try:
        lines = _lines(spark, path)
        splits = materialize(_splits(lines))
        headers = sorted(r[0] for r in splits.where("header IS NOT NULL").select("header").distinct().collect())
        if any(h.count('"') % 2 for h in headers):
            raise ValueError("a CSV header holds a line break")
        records = materialize((_records if multiline else _single_lines)(lines, splits))
    finally:
        spark.conf.set(size, before)
    if not headers:
        return spark.createDataFrame([], T.StructType([*[T.StructField(n, T.StringType()) for n in COLUMN_RENAME_MAP], *T.StructType.fromDDL(f"{SEQ} {_SEQ_TYPE}").fields]))
    return mark_na(_parsed(records, headers))


def write_csv(df: DataFrame, path: str) -> None:
    """A2: clean CSV sink, overwritten, with a header. Values are written as
    they are (the writer's default trimming of edge whitespace is off)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def verify_written(spark: SparkSession, path: str, expected_rows: int | None = None,
                   fmt: str = "csv") -> int:
    """A3: read the output back; fail when it is missing or the count differs."""
    reader = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
              if fmt == "csv" else spark.read)
    n = reader.format(fmt).load(path).count()
    if expected_rows is not None and n != expected_rows:
        raise RuntimeError(f"output {path} has {n} rows, expected {expected_rows}")
    return n
