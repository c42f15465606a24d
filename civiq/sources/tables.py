"""Report-shaped views over the driver's parquet tables.

* ``reports``      (V): orders x customer x nation as clean reports.
* ``raw_reports``  (R): dirty raw strings over ``reports`` with the raw headers.
* ``text_reports`` (T): documents as searchable reports.
* ``search_queries`` (B): benchmark texts, whole, as search queries.
* ``questions``    (Q): the literal question fixtures plus every user turn of
  ``conversations`` (so the question workload grows with the data).

All views are lazy DataFrames: scans prune columns and push filters down.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Literal question fixtures (id, text): each covers a parsing rule.
QUESTION_FIXTURES = [
    (1, "¿Cuantos reportes urgentes hay en NATION_3 en 1997?"),
    (2, "¿Cuántos registros hay en 1998-2?"),
    (3, "cantidad de registros entre 1996 y 1998"),
    (4, "cantidad de reportes entre 1999 y 1996"),
    (5, "¿Qué ciudad tiene más reportes en marzo 1997?"),
    (6, "¿Qué categoría tiene mas registros?"),
    (7, "¿En qué mes hubo más reportes de BUILDING?"),
    (8, "principales problemas de la ciudad"),
    (9, "reportes de NATION_12 en la mayoría de 1999"),
    (10, "cantidad de reportes en 1997-45"),
    (11, "mes con más reportes en 2030"),
    (12, "¿?, !"),
    (13, "Setiembre 1998 FURNITURE urgente"),
    (14, "1996-1998 cantidad reportes"),
    (15, "###"),
    (16, "!!"),
    (17, "***"),
    (18, "&&&"),
]

# Questions about every nation: id base and the words around its name.
NATION_QUESTIONS = [
    (1000, "cantidad de reportes urgentes en ", " entre 1995 y 1997"),
    (2000, "en que mes hubo mas reportes de ", ""),
    (3000, "cantidad de reportes de ", " en 1996"),
]

# Question ids of conversation turns: (conv_id + 1) * 2**32 + turn, which no two
# turns share as long as a conversation has fewer than 2**32 of them.
CONVERSATION_ID_BASE = 1 << 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean reports (V). nation is a fixed 25-row dimension, so it is
    broadcast; orders x customer is left to the planner (AQE turns it into a
    broadcast join at run time when customer is small enough)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    j = o.join(c, o.o_custkey == c.c_custkey).join(
        F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_name").alias("nombre"),
        ((F.col("c_custkey") * 7 + F.col("o_orderkey")) % 90 + 10).cast("int").alias("edad"),
        F.when(F.col("o_orderstatus") == "F", "F")
        .when(F.col("o_orderstatus") == "O", "Otro").otherwise("M").alias("genero"),
        F.col("n_name").alias("ciudad"),
        F.concat_ws(" ", "c_mktsegment", "o_orderpriority", "n_name").alias("comentario"),
        F.col("c_mktsegment").alias("categoria_problema"),
        F.when(urgent, "Urgente").otherwise("No urgente").alias("nivel_urgencia"),
        _flag(urgent).alias("urgente"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("fecha_reporte"),
        _flag(F.col("o_totalprice") > 200000).alias("acceso_internet"),
        _flag(F.col("c_acctbal") > 5000).alias("atencion_previa_gobierno"),
        _flag(F.col("n_regionkey").isin(0, 2)).alias("zona_rural"),
    )


def _rules(idc: Column, rules: list[tuple[int, Column]], default: Column) -> Column:
    """First matching ``id % n == 0`` rule wins."""
    out = None
    for mod, val in rules:
        cond = idc % mod == 0
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default) if out is not None else default


def raw_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw reports (R): every value a string, raw Spanish headers, an
    arrival-order ``seq``."""
    v = reports(spark, sf_dir)
    i = F.col("id")
    s = lambda x: F.lit(x).cast("string")
    null = F.lit(None).cast("string")
    f = F.col("fecha_reporte")
    us_date = F.concat(F.substring(f, 6, 2), F.lit("/"), F.substring(f, 9, 2), F.lit("/"),
                       F.substring(f, 1, 4))
    flag = lambda c: F.col(c).cast("string")
    id_raw = (F.when(i % 97 == 0, null).when(i % 89 == 0, s("x"))
              .when(i % 103 == 0, s("1e30")).when(i % 107 == 0, s("9007199254740992"))
              .when(i % 109 == 0, s("9007199254740993"))
              .when(i % 10 == 9, (i - 1).cast("string"))
              .when(i % 13 == 0, F.concat(i.cast("string"), s(".0")))
              .otherwise(i.cast("string")))
    return v.select(
        i.alias("seq"),
        id_raw.alias("ID"),
        _rules(i, [(101, null)], F.concat(s(" "), F.col("nombre"), s(" "))).alias("Nombre"),
        _rules(i, [(17, s("130")), (19, s("abc")), (23, s("-0.5")), (29, s("120.5")),
                   (31, s("NaN")), (37, s("1d")), (43, s("9999999999"))],
               F.concat(F.col("edad").cast("string"), s(".0"))).alias("Edad"),
        _rules(i, [(11, s("O")), (41, s("femenino"))], F.col("genero")).alias("Género"),
        _rules(i, [(43, s("   "))], F.concat(s("  "), F.col("ciudad"), s(" "))).alias("Ciudad"),
        _rules(i, [(47, s(" NaN ")), (53, s("   ")), (59, s("null"))],
               F.col("comentario")).alias("Comentario"),
        F.col("categoria_problema").alias("Categoría del problema"),
        _rules(i, [(5, s(" ALTA ")), (71, s("media")), (7, s("Baja urgencia"))],
               F.col("nivel_urgencia")).alias("Nivel de urgencia"),
        _rules(i, [(61, s("2020-13-45")), (6, us_date), (4, F.concat(f, s(" 10:30:00"))),
                   (7, F.concat_ws("/", F.substring(f, 6, 2).cast("int"), F.substring(f, 9, 2).cast("int"), F.substring(f, 1, 4))),
                   (11, F.concat(f, s("T10:30:00"))), (13, F.concat(f, s(" 10:30"))),
                   (17, F.replace(f, F.lit("-"), F.lit("/"))), (19, F.concat(f, s(" 10:30:00.5"))),
                   (23, F.concat(us_date, s(" 10:30:00")))],
               f).alias("Fecha del reporte"),
        _rules(i, [(73, s("2")), (3, F.concat(flag("acceso_internet"), s(".0")))],
               flag("acceso_internet")).alias("Acceso a internet"),
        _rules(i, [(79, s("0.5"))], flag("atencion_previa_gobierno"))
        .alias("Atención previa del gobierno"),
        _rules(i, [(83, s("True"))], flag("zona_rural")).alias("Zona rural"),
    )


def text_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as searchable reports (T)."""
    d = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    fecha = F.concat(
        (F.lit(2020) + i % 5).cast("string"), F.lit("-"),
        F.lpad((i % 12 + 1).cast("string"), 2, "0"), F.lit("-"),
        F.lpad((i % 28 + 1).cast("string"), 2, "0"))
    return d.select(
        i.alias("id"),
        F.col("text").alias("comentario"),
        F.col("source").alias("ciudad"),
        F.col("lang").alias("categoria_problema"),
        fecha.alias("fecha_reporte"),
        _flag(i % 3 == 0).alias("urgente"),
    )


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts as search queries (B), whole."""
    b = table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("question_id"), F.col("text").alias("texto"))


def passage_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark text whole and without its first letter (it begins inside
    a document's text where the document holds the passage), and punctuation."""
    b = search_queries(spark, sf_dir)
    inner = b.select((F.col("question_id") * 2 + 1).alias("question_id"), F.expr("substring(texto, 2)").alias("texto"))
    marks = question_fixtures(spark).where(F.col("question_id") >= 15)
    whole = b.select((F.col("question_id") * 2).alias("question_id"), "texto")
    return whole.unionByName(inner).unionByName(marks.select((-F.col("question_id")).alias("question_id"), "texto"))


def wildcard_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIKE patterns from every benchmark text: words joined by ``_``, its two
    ends joined by ``%``, a backslash inside, and one without three letters in a
    row."""
    b = search_queries(spark, sf_dir)
    t, i = F.col("texto"), F.col("question_id") * 4
    forms = [F.replace(t, F.lit(" "), F.lit("_")), F.concat(F.expr("substring(texto, 1, 24)"), F.lit("%"), F.expr("right(texto, 24)")),
             F.concat(F.expr("substring(texto, 1, 12)"), F.lit("\\"), F.expr("substring(texto, 13, 12)")),
             F.concat(F.lit("_"), F.expr("substring(texto, 2, 2)"), F.lit("%x_"))]
    return b.select(F.explode(F.array(*[F.struct((i + k).alias("question_id"), f.alias("texto")) for k, f in enumerate(forms)])).alias("p")).select("p.*")


def question_fixtures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(QUESTION_FIXTURES, "question_id long, texto string")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions (Q): literal fixtures plus all user turns of conversations."""
    conv = table(spark, sf_dir, "conversations")
    turns = conv.where(F.col("role") == "user").select(
        ((F.col("conv_id") + 1) * CONVERSATION_ID_BASE + F.col("turn")).alias("question_id"),
        F.col("text").alias("texto"))
    out = question_fixtures(spark).unionByName(turns)
    n = table(spark, sf_dir, "nation")
    for base, before, after in NATION_QUESTIONS:
        out = out.unionByName(n.select(
            (F.lit(base) + F.col("n_nationkey")).cast("long").alias("question_id"),
            F.concat(F.lit(before), F.col("n_name"), F.lit(after)).alias("texto")))
    return out


def day_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of days per conversation turn: any days, also ones that no
    calendar has, open ends, and ends in the wrong order."""
    conv = table(spark, sf_dir, "conversations")
    i, j = F.col("conv_id") * 37 + F.col("turn") * 101, F.col("conv_id") * 53 + F.col("turn") * 7
    null = F.lit(None).cast("string")

    def day(x):
        return F.format_string("%d-%02d-%02d", (x % 8 + 1992).cast("int"), (x % 13 + 1).cast("int"), (x % 31 + 1).cast("int"))

    return conv.select(
        ((F.col("conv_id") + 1) * CONVERSATION_ID_BASE + F.col("turn")).alias("question_id"),
        F.when(i % 11 == 0, null).when(i % 11 == 1, F.lit("")).otherwise(day(i)).alias("f_fecha_desde"),
        F.when(j % 9 == 0, null).otherwise(day(j)).alias("f_fecha_hasta"))


def source_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One search query per source and language of the documents: their names,
    which many documents hold."""
    return (table(spark, sf_dir, "documents").groupBy("source", "lang")
            .agg(F.min("doc_id").alias("question_id"))
            .select("question_id", F.concat_ws(" ", "source", "lang").alias("texto")))


def filtered_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source queries and punctuation, each with filters of its own."""
    i = F.col("question_id")
    q = source_queries(spark, sf_dir).unionByName(
        question_fixtures(spark).where(F.col("question_id") >= 15)
        .select((-i).alias("question_id"), "texto"))
    null = F.lit(None).cast("string")
    return q.select(
        "question_id", "texto",
        F.when(i % 3 == 0, F.lit("src0")).otherwise(null).alias("f_ciudad"),
        F.when(i % 5 == 0, F.lit("en")).otherwise(null).alias("f_categoria_problema"),
        F.when(i % 2 == 0, F.lit(1)).otherwise(F.lit(None).cast("int")).alias("f_urgente"),
        F.lit("2021-01-01").alias("f_fecha_desde"),
        F.when(i % 7 == 0, F.lit("2023-06-30")).otherwise(F.lit("")).alias("f_fecha_hasta"))
