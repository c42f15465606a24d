"""Cleaning, validation and de-duplication of raw reports.

The rules are narrow projections and filters. De-duplication by id writes the
valid rows once, counts ids alone and compares only rows with a repeated id, by an
aggregate (``min_by``/``max_by`` on the arrival order) rather than a window, so Spark
combines duplicates map-side and a hot id never lands in one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import day_first_votes, parse_date_iso
from ..functions.numeric import to_flag, to_int_half_even, to_long
from ..functions.text import strip_ws
from ..schema import (
    COLUMN_RENAME_MAP,
    COMMENT_NULL_MARKERS,
    FLAG_COLUMNS,
    GENERO_MAP,
    NA_MARKERS,
    NOT_URGENT_LABELS,
    REPORT_COLUMNS,
    REQUIRED_FIELDS,
    URGENT_LABELS,
)
from ..session import materialize
from .sketch import key_sketch, mark_held

SEQ = "seq"
#: Whether the dates of a row's file are written with the day first.
DAY_FIRST = "_day_first"


def _string_cols(df: DataFrame, skip: tuple[str, ...] = (SEQ,)) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in skip]


def _replace(df: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    return df.withColumns(mapping)


def mark_na(df: DataFrame) -> DataFrame:
    """A1 (missing values): a cell equal to an NA marker becomes null. Matched on
    the untrimmed text, so ``'   '`` is not missing."""
    return _replace(df, {c: F.when(~F.col(c).isin(NA_MARKERS), F.col(c))
                         for c in _string_cols(df)})


def rename_columns(df: DataFrame) -> DataFrame:
    """B1: raw headers to clean names; absent headers are ignored."""
    return df.withColumnsRenamed({k: v for k, v in COLUMN_RENAME_MAP.items() if k in df.columns})


def trim_strings(df: DataFrame) -> DataFrame:
    """B2: strip Unicode whitespace from every string column."""
    return _replace(df, {c: strip_ws(c) for c in _string_cols(df)})


def clean_comment_nulls(df: DataFrame) -> DataFrame:
    """Blank / nan / none / null comments (any case) become null."""
    if "comentario" not in df.columns:
        return df
    c = F.col("comentario")
    return df.withColumn("comentario", F.when(~F.lower(c).isin(COMMENT_NULL_MARKERS), c))


# One expression per rule; the single-rule operators and the pipeline share them.

def fecha_expr(day_first: Column | None = None) -> Column:
    """Parse the known styles, keep the day as ISO text."""
    return parse_date_iso("fecha_reporte", day_first=day_first)


def day_first_files(raw: DataFrame, date_col: str = "Fecha del reporte") -> DataFrame:
    """B4, the style of a column: (file, _day_first) of the files whose dates are
    read with the day first. Every cell that can be read one way or the other
    votes; a 13th month shows which way is wrong; of equal votes the month comes
    first. One aggregate, a row per file."""
    day, month = day_first_votes(strip_ws(date_col))
    votes = raw.groupBy(F.col(f"{SEQ}.file").alias("file")).agg(F.count_if(day).alias("day"), F.count_if(month).alias("month"))
    return votes.where("day > month").select("file", F.lit(True).alias(DAY_FIRST))


def with_date_style(raw: DataFrame, date_col: str = "Fecha del reporte") -> DataFrame:
    """Raw rows with the style of their file's dates. The broadcast table has a
    row per file at most, fewer than the file list that the driver plans with."""
    if date_col not in raw.columns:
        return raw
    file = F.col(f"{SEQ}.file")
    winners = day_first_files(raw, date_col).withColumnRenamed("file", "_file")
    return (raw.join(F.broadcast(winners), file == F.col("_file"), "left").drop("_file")
            .withColumn(DAY_FIRST, F.coalesce(DAY_FIRST, F.lit(False))))


def edad_expr() -> Column:
    """B5 + C1: numeric age rounded half-even, null unless 0 <= age <= 120 (the
    range is tested before the cast, so no number overflows)."""
    e = to_int_half_even("edad")
    return F.when(e.between(0, 120), e.cast("int"))


def genero_expr() -> Column:
    """Exact value map, anything else null."""
    g = F.col("genero")
    pairs = iter(GENERO_MAP.items())
    k, v = next(pairs)
    out = F.when(g == k, F.lit(v))
    for k, v in pairs:
        out = out.when(g == k, F.lit(v))
    return out


def urgente_expr() -> Column:
    """Urgency label to 1 / 0 / null (trimmed, case-insensitive)."""
    s = F.lower(strip_ws(F.col("nivel_urgencia")))
    return F.when(s.isin(URGENT_LABELS), F.lit(1)).when(s.isin(NOT_URGENT_LABELS), F.lit(0))


def normalize_fecha(df: DataFrame) -> DataFrame:
    """B4 on a table (with the style of each row's file, if that is known)."""
    return df.withColumn("fecha_reporte", fecha_expr(F.col(DAY_FIRST) if DAY_FIRST in df.columns else None))


def normalize_edad(df: DataFrame) -> DataFrame:
    """B5 + C1 on a table: rows with an age in range."""
    return df.withColumn("edad", edad_expr()).where(F.col("edad").isNotNull())


def normalize_genero(df: DataFrame) -> DataFrame:
    """B6 on a table."""
    return df.withColumn("genero", genero_expr())


def normalize_flags(df: DataFrame) -> DataFrame:
    """Flag columns to 0/1 integers; other values null."""
    return _replace(df, {c: to_flag(c) for c in FLAG_COLUMNS if c in df.columns})


def normalize_urgencia(df: DataFrame) -> DataFrame:
    """B8 on a table."""
    return df.withColumn("urgente", urgente_expr())


def normalized(df: DataFrame) -> DataFrame:
    """B1-B9 as one flat projection plus a ``_valid`` flag (C1-C3): every row,
    with null where a value is missing or cannot be read."""
    df = clean_comment_nulls(trim_strings(rename_columns(df)))
    out = df.select(
        *[c for c in df.columns if c not in (*REPORT_COLUMNS, DAY_FIRST)],
        to_long("id").alias("id"),
        "nombre",
        edad_expr().alias("edad"),
        genero_expr().alias("genero"),
        "ciudad", "comentario", "categoria_problema", "nivel_urgencia",
        urgente_expr().alias("urgente"),
        fecha_expr(F.col(DAY_FIRST) if DAY_FIRST in df.columns else None).alias("fecha_reporte"),
        *[to_flag(c).alias(c) for c in FLAG_COLUMNS],
    )
    valid = F.col("id").isNotNull() & F.col("urgente").isNotNull()
    for c in REQUIRED_FIELDS:
        valid = valid & F.col(c).isNotNull()
    return out.withColumn("_valid", valid)


def _computed(df: DataFrame) -> DataFrame:
    """The same rows; a later filter is not moved below. A filter that is would
    repeat every rule that it needs, in a method too long to compile."""
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def validate(df: DataFrame) -> DataFrame:
    """Every row that would survive, normalized."""
    return _computed(normalized(df)).where(F.col("_valid")).drop("_valid")


def _pick(df: DataFrame, key: str, order: str, last: bool) -> DataFrame:
    cols = [c for c in df.columns if c != key]
    rec = F.struct(*cols)
    pick = F.max_by(rec, F.col(order)) if last else F.min_by(rec, F.col(order))
    return df.groupBy(key).agg(pick.alias("_r")).select(key, "_r.*")


def dedup_first(df: DataFrame, key: str = "id", order: str = SEQ) -> DataFrame:
    """Keep the first row (smallest ``order``) per key.

    Rows are written once. Keys are then counted alone, and only rows whose key is
    (or shares its sketch bit with) a repeated one are compared; all others pass
    by without a shuffle or a sort."""
    rows = materialize(df)
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    marked = mark_held(rows, materialize(key_sketch(repeated, key)), key, "_again")
    cols = [key, *[c for c in df.columns if c != key]]
    single = marked.where(~F.col("_again")).select(*cols)
    return single.unionByName(_pick(marked.where("_again").select(*cols), key, order, last=False))


def upsert_last_wins(df: DataFrame, key: str = "id", order: str = SEQ) -> DataFrame:
    """A5: keep the last row (largest ``order``) per key - the upsert
    semantics of loading rows one by one into a keyed table."""
    return _pick(df, key, order, last=True)


def upsert(current: DataFrame, incoming: DataFrame, key: str = "id", order: str = SEQ) -> DataFrame:
    """A5 for two tables: incoming rows replace current rows with the same key.
    ``current`` is a keyed table (one row per key). A bit sketch of the incoming keys
    tells which stored rows can be replaced: only these are shuffled to meet the
    incoming ones, the others pass by. Of incoming rows with one key the last by ``order`` wins; without that
    column the keys of ``incoming`` must be unique, else there is no last row."""
    if order not in incoming.columns:
        if incoming.groupBy(key).count().where("count > 1").limit(1).count():
            raise ValueError(f"incoming rows repeat a key and have no column {order!r} that orders them")
        incoming = incoming.withColumn(order, F.lit(0))
    cols = [c for c in current.columns if c != order]
    rows = incoming.select(*cols, F.lit(1).alias("_src"), F.col(order).alias("_ord"))
    kind = rows.schema["_ord"].dataType
    old = current.select(*cols, F.lit(0).alias("_src"), (
        F.col(order).cast(kind) if order in current.columns else F.lit(None).cast(kind)).alias("_ord"))
    marked = mark_held(old, materialize(key_sketch(incoming, key)), key, "_touched")
    both = marked.where("_touched").drop("_touched").unionByName(rows).withColumn("_key", F.struct("_src", "_ord"))
    picked = upsert_last_wins(both, key, "_key").drop("_key")
    whole = marked.where(~F.col("_touched")).drop("_touched").unionByName(picked)
    return whole.select(*[F.col("_ord").alias(c) if c == order else c for c in current.columns])


def select_clean(df: DataFrame) -> DataFrame:
    """The 13 clean columns in order, typed."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in _clean_fields() if f.name in df.columns])


def _clean_fields():
    from ..schema import REPORT_SCHEMA
    return REPORT_SCHEMA.fields


def transform(raw: DataFrame) -> DataFrame:
    """The whole cleaning pipeline (raw strings with a ``seq`` arrival
    order -> clean reports, unique id, first valid row wins).

    Rows that do not survive are dropped in the scan; of the others only those
    with a repeated id are shuffled (``dedup_first``).
    """
    return select_clean(dedup_first(validate(mark_na(raw)).select(SEQ, *REPORT_COLUMNS)))


def row_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """A10: source and cleaned row counts in one row."""
    return raw.agg(F.count(F.lit(1)).alias("source_rows")).select(
        "source_rows", clean.select(F.count(F.lit(1))).scalar().alias("clean_rows"))


def assert_not_null(df: DataFrame, cols: list[str] | None = None) -> None:
    """NOT NULL check of the table sink: one aggregate, raises on a null."""
    cols = cols or [c for c in REPORT_COLUMNS if c in df.columns]
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise ValueError(f"null values in NOT NULL columns: {bad}")
