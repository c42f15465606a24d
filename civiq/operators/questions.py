"""Natural-language questions -> date windows, intents, mentions, statistics.

Batch design (one job for any number of questions):

1. ``parse_questions`` - narrow: normalized text, date window, intent flags.
2. ``ReportCube`` - reports aggregated once to (day, city, category) ->
   (n, n_urgent), materialized by a checkpoint. Reports are never joined to
   questions row by row.
3. Date windows (``windows.py``). A window of days is a difference of two running
   sums, found for all distinct windows by one union and one sort; the month with
   most reports comes from a sparse table. No row per window and month.
4. Mentions: a gram-signature join. Each name is filed under its rarest gram and
   tested against the questions that hold this gram; one plan at every size.
5. Statistics lines are rows ``(question_id, group, key1, key2, line)`` from
   each source, unioned and ordered per question.
"""

from __future__ import annotations

import functools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..functions.text import WORD_CLASS, contains_any, fold, name_grams, strip_ws, text_grams
from ..schema import (
    ANSWER_PEAK_MONTH,
    ANSWER_TOP_CATEGORY,
    ANSWER_TOP_CITY,
    ANSWER_TOTAL,
    ANSWER_URGENT_TOTAL,
    CATEGORY_WORD,
    CITY_WORD,
    COUNT_WORDS,
    LINE_CATEGORY,
    LINE_CITY,
    LINE_PEAK_MONTH,
    LINE_TOP_CATEGORY,
    LINE_TOP_CITY,
    LINE_TOTAL,
    LINE_TOTAL_URGENT,
    LINE_URGENT_SUFFIX,
    MONTH_WORD,
    MONTHS_ES,
    MORE_WORDS,
    RECORD_WORDS,
    URGENT_WORDS,
)
from ..session import materialize
from .windows import NO_DATE, ends, peak_months, window_counts

NO_WINDOW = "*"
_NOT_WORD = rf"[^{WORD_CLASS}]+"
_YEAR_MONTH = rf"(?<![{WORD_CLASS}])((?:19|20)[0-9]{{2}})-([0-9]{{1,2}})(?![{WORD_CLASS}])"


def _fmt(template: str, *cols: Column) -> Column:
    return F.format_string(template.replace("{}", "%s"), *cols)


# ---------------------------------------------------------------------------
# 1. Parsing
# ---------------------------------------------------------------------------

def extract_dates(q: Column) -> tuple[Column, Column]:
    """(fecha_desde, fecha_hasta) from lower-cased question text.

    ``YYYY-M[M]`` wins; else a month name (calendar order, substring) with the
    first year; else first year .. last year; else no window (nulls).
    """
    ym_y = F.regexp_extract(q, _YEAR_MONTH, 1)
    ym_m = F.lpad(F.regexp_extract(q, _YEAR_MONTH, 2).try_cast("int").cast("string"), 2, "0")
    years = F.filter(F.split(q, _NOT_WORD), lambda t: t.rlike("^(19|20)[0-9]{2}$"))
    first, last = F.try_element_at(years, F.lit(1)), F.try_element_at(years, F.lit(-1))
    month = None
    for name, num in MONTHS_ES:
        month = (F.when(q.contains(name), F.lit(num)) if month is None
                 else month.when(q.contains(name), F.lit(num)))
    has_ym = ym_y != ""
    has_y = F.size(years) > 0
    desde = (F.when(has_ym, F.concat_ws("-", ym_y, ym_m, F.lit("01")))
             .when(has_y & month.isNotNull(), F.concat_ws("-", first, month, F.lit("01")))
             .when(has_y, F.concat(first, F.lit("-01-01"))))
    hasta = (F.when(has_ym, F.concat_ws("-", ym_y, ym_m, F.lit("31")))
             .when(has_y & month.isNotNull(), F.concat_ws("-", first, month, F.lit("31")))
             .when(has_y, F.concat(last, F.lit("-12-31"))))
    return desde, hasta


def parse_questions(questions: DataFrame) -> DataFrame:
    """Normalized text, window and intent flags per question."""
    q = F.lower(strip_ws(F.col("texto")))
    p = questions.select("question_id", "texto", q.alias("q"))
    desde, hasta = extract_dates(F.col("q"))
    qc = F.col("q")
    more = contains_any(qc, MORE_WORDS)
    records = contains_any(qc, RECORD_WORDS)
    return p.select(
        "question_id", "texto", "q", fold("q").alias("q_norm"),
        desde.alias("fecha_desde"), hasta.alias("fecha_hasta"),
        (contains_any(qc, COUNT_WORDS) & records).alias("f_count"),
        contains_any(qc, URGENT_WORDS).alias("f_urgent"),
        (more & qc.contains(CITY_WORD)).alias("f_top_city"),
        (more & qc.contains(CATEGORY_WORD)).alias("f_top_category"),
        qc.contains(MONTH_WORD).alias("f_month"),
        # the direct-answer city test also needs a report word
        (more & qc.contains(CITY_WORD) & records).alias("f_answer_city"),
        (more & qc.contains(MONTH_WORD)).alias("f_answer_month"),
    ).withColumn("wkey", F.when(F.col("fecha_desde").isNull(), F.lit(NO_WINDOW)).otherwise(
        F.concat_ws("|", "fecha_desde", "fecha_hasta")))


# ---------------------------------------------------------------------------
# 2-3. Cube and windows
# ---------------------------------------------------------------------------

class ReportCube:
    """Reports pre-aggregated to (fecha, ciudad, categoria_problema)."""

    def __init__(self, reports: DataFrame, checkpoint: bool = True):
        cube = reports.groupBy(
            F.col("fecha_reporte").alias("fecha"), "ciudad", "categoria_problema"
        ).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("urgente") == 1).alias("n_urg"))
        cube = cube.withColumn("mes", month_key("fecha"))
        self.cube = materialize(cube) if checkpoint else cube

    def by(self, *keys: str) -> DataFrame:
        return self.cube.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("n_urg").alias("n_urg"))


class WindowStats:
    """Counts per (window, key) for the windows of a question batch. Rows whose
    date is null count in no window but the open one."""

    def __init__(self, parsed: DataFrame, cube: ReportCube):
        self.cube = cube
        self.parsed = parsed
        self._totals: DataFrame | None = None

    @functools.cached_property
    def windows(self) -> DataFrame:
        """(wkey, desde, hasta): the distinct windows with both ends."""
        desde, hasta = ends(F.col("fecha_desde"), F.col("fecha_hasta"))
        return materialize(self.parsed.select("wkey", desde.alias("desde"), hasta.alias("hasta")).distinct())

    def days(self, *keys: str) -> DataFrame:
        """(*keys, fecha, n, n_urg) of the written cube."""
        return self.cube.by(*keys, "fecha").withColumn("fecha", F.coalesce("fecha", F.lit(NO_DATE)))

    def totals(self) -> DataFrame:
        """(wkey, n, n_urg) of every window."""
        if self._totals is None:
            self._totals = materialize(window_counts(self.days(), self.windows))
        return self._totals

    def pairs(self, asked: DataFrame, key: str) -> DataFrame:
        """asked(wkey, key) -> (wkey, key, n, n_urg)."""
        pairs = asked.select("wkey", key).distinct().join(self.windows, "wkey")
        return window_counts(self.days(key), pairs, (key,))

    def top(self, key: str, asked: DataFrame | None = None) -> DataFrame:
        """(wkey, key, n): most reports in the window, ties by name; for all
        windows or those of asked(wkey). One row per window and name; the
        windows that questions can name are bounded (60,001), so their list is
        broadcast to the names."""
        windows = self.windows if asked is None else self.windows.join(asked.select("wkey").distinct(), "wkey", "left_semi")
        names = self.days(key).select(key).distinct()
        each = names.join(F.broadcast(windows.agg(F.collect_list(F.struct("wkey", "desde", "hasta")).alias("_w"))), how="cross")
        counts = window_counts(self.days(key), each.select(key, F.inline("_w")), (key,)).where("n > 0")
        best = counts.groupBy("wkey").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(key).alias("k"))).alias("b"))
        return best.select("wkey", F.col("b.k").alias(key), (-F.col("b.neg")).alias("n"))

    def peak_month(self, asked: DataFrame | None = None) -> DataFrame:
        """(wkey, mes, n): month with most reports, earliest on ties."""
        windows = self.windows if asked is None else self.windows.join(asked.select("wkey").distinct(), "wkey", "left_semi")
        return peak_months(self.days(), windows)


def totals_in_windows(windows: DataFrame, reports: DataFrame) -> DataFrame:
    """D4 for any windows of days: (question_id, fecha_desde, fecha_hasta) ->
    those and total, total_urgentes. Null and empty ends are open."""
    desde, hasta = ends(F.col("fecha_desde"), F.col("fecha_hasta"))
    keyed = windows.select("question_id", "fecha_desde", "fecha_hasta", desde.alias("desde"), hasta.alias("hasta"))
    keyed = materialize(keyed.withColumn("wkey", F.concat_ws("|", "desde", "hasta")))
    days = ReportCube(reports).by("fecha").withColumn("fecha", F.coalesce("fecha", F.lit(NO_DATE)))
    counts = window_counts(days, keyed.select("wkey", "desde", "hasta").distinct())
    return keyed.join(counts, "wkey").select("question_id", "fecha_desde", "fecha_hasta", F.col("n").alias("total"), F.col("n_urg").alias("total_urgentes"))


# ---------------------------------------------------------------------------
# 4. Mentions (D3)
# ---------------------------------------------------------------------------

#: Letters of a gram; shorter names are their own gram.
GRAM = 3


def name_dimension(cube: ReportCube, key: str, allow_empty_norm: bool) -> DataFrame:
    """(name, name_norm, n_global): names present in the reports, by global count."""
    d = cube.by(key).select(F.col(key).alias("name"), F.col("n").alias("n_global"))
    d = d.where(F.col("name") != "").withColumn("name_norm", fold("name"))
    if not allow_empty_norm:
        d = d.where(F.col("name_norm") != "")
    return d


def mention_join(parsed: DataFrame, dim: DataFrame) -> DataFrame:
    """(question_id, kind, name, n_global) for every name of dim(kind, name,
    n_global, name_norm) that the question contains.

    A gram-signature join: a text that contains a name contains every gram of it,
    so each name is filed under the one of its grams that fewest texts hold, and
    meets only the texts that hold that gram; those are tested. A name with a gram
    that no text holds is dropped. Texts that repeat are looked at once. Only
    texts' grams that are grams of names leave the task that makes them."""
    qs = parsed.select("question_id", "q_norm")
    # at most GRAM + 1 lengths
    lengths = sorted(r[0] for r in dim.select(F.least(F.length("name_norm"), F.lit(GRAM)).alias("l")).distinct().collect())
    grams = qs.select("q_norm").distinct().select("q_norm", F.explode_outer(F.array_distinct(text_grams(F.col("q_norm"), lengths))).alias("gram"))
    split = dim.select("kind", "name", F.explode(name_grams(F.col("name_norm"), GRAM)).alias("gram"))
    held = grams.join(split.select("gram").distinct(), "gram").groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    filed = (split.join(held, "gram", "left").groupBy("kind", "name").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("r"))
             .where("r.df > 0").select("kind", "name", F.col("r.gram").alias("gram")))
    found = grams.join(dim.join(filed, ["kind", "name"]), "gram").where(F.col("q_norm").contains(F.col("name_norm")))
    return qs.join(found.select("q_norm", "kind", "name", "n_global"), "q_norm").select("question_id", "kind", "name", "n_global")


def mentions(parsed: DataFrame, cube: ReportCube, *kinds: str) -> DataFrame:
    """Mentions of the names of a kind (city, category) or of both, in one join."""
    dims = {"city": lambda: name_dimension(cube, "ciudad", allow_empty_norm=False),
            "category": lambda: name_dimension(cube, "categoria_problema", allow_empty_norm=True)}
    return mention_join(parsed, materialize(reduce(DataFrame.unionByName, [dims[k]().withColumn("kind", F.lit(k)) for k in kinds])))


# ---------------------------------------------------------------------------
# 5. Statistics lines (G5) and direct answers
# ---------------------------------------------------------------------------

class QuestionStats:
    def __init__(self, questions: DataFrame, reports: DataFrame):
        # Parsed once: every statistics branch reads the same window and
        # intent columns, so the regex parsing is not repeated per branch.
        self.parsed = materialize(parse_questions(questions))
        self.cube = ReportCube(reports)
        self.ws = WindowStats(self.parsed, self.cube)
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name: str, build) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    def city_mentions(self) -> DataFrame:
        return self._get("mc", lambda: mentions(self.parsed, self.cube, "city"))

    def category_mentions(self) -> DataFrame:
        return self._get("mk", lambda: mentions(self.parsed, self.cube, "category"))

    def _found(self, kind: str) -> DataFrame:
        """The mentions of a kind; both kinds are found together and written
        once for the lines that read them."""
        both = self._get("found", lambda: materialize(mentions(self.parsed, self.cube, "city", "category")))
        return both.where(F.col("kind") == kind).drop("kind")

    def totals(self) -> DataFrame:
        """(question_id, fecha_desde, fecha_hasta, total, total_urgentes)."""
        t = self.ws.totals()
        return self.parsed.join(t, "wkey", "left").select(
            "question_id", "fecha_desde", "fecha_hasta",
            F.coalesce("n", F.lit(0)).cast("long").alias("total"),
            F.coalesce("n_urg", F.lit(0)).cast("long").alias("total_urgentes"))

    def top_per_question(self, key: str, out: str) -> DataFrame:
        """(question_id, out, count) within the question's window."""
        t = self.ws.peak_month() if key == "mes" else self.ws.top(key)
        return self.parsed.join(t, "wkey").select(
            "question_id", F.col(key).alias(out), F.col("n").cast("long").alias("count"))

    def peak_month(self) -> DataFrame:
        """(question_id, mes, count)."""
        return self.top_per_question("mes", "mes")

    def _mention_lines(self, m: DataFrame, key: str, template: str, group: int) -> DataFrame:
        p = self.parsed.select("question_id", "wkey", "f_urgent")
        j = m.join(p, "question_id")
        counts = self.ws.pairs(j.select("wkey", F.col("name").alias(key)), key).withColumnRenamed(key, "name")
        j = j.join(counts, ["wkey", "name"], "left")
        cnt = F.coalesce("n", F.lit(0)).cast("long")
        urg = F.coalesce("n_urg", F.lit(0)).cast("long")
        line = F.concat(_fmt(template, F.col("name"), cnt),
                        F.when(F.col("f_urgent"), _fmt(LINE_URGENT_SUFFIX, urg)).otherwise(F.lit("")))
        return j.select("question_id", F.lit(group).alias("g"), (-F.col("n_global")).alias("k1"),
                        F.col("name").alias("k2"), line.alias("line"))

    def lines(self) -> DataFrame:
        """G5 long form: (question_id, line_no, line)."""
        p = self.parsed
        tot = p.where("f_count").join(self.ws.totals(), "wkey", "left").select(
            "question_id", "f_urgent", F.coalesce("n", F.lit(0)).cast("long").alias("total"),
            F.coalesce("n_urg", F.lit(0)).cast("long").alias("total_urgentes"))
        zero = F.lit(0).cast("long")
        blank = F.lit("")

        def row(df, g, line):
            return df.select("question_id", F.lit(g).alias("g"), zero.alias("k1"),
                             blank.alias("k2"), line.alias("line"))

        parts = [
            row(tot.where("f_urgent"), 1,
                _fmt(LINE_TOTAL_URGENT, F.col("total_urgentes"))),
            row(tot, 2, _fmt(LINE_TOTAL, F.col("total"))),
            self._mention_lines(self._found("city"), "ciudad", LINE_CITY, 3),
            self._mention_lines(self._found("category"), "categoria_problema", LINE_CATEGORY, 4),
        ]
        tc = p.where("f_top_city").join(self._found("city"), "question_id", "left_anti")
        tc = tc.join(self.ws.top("ciudad", tc), "wkey")
        parts.append(row(tc, 5, _fmt(LINE_TOP_CITY, F.col("ciudad"), F.col("n"))))
        tk = p.where("f_top_category").join(self._found("category"), "question_id", "left_anti")
        tk = tk.join(self.ws.top("categoria_problema", tk), "wkey")
        parts.append(row(tk, 6, _fmt(LINE_TOP_CATEGORY, F.col("categoria_problema"), F.col("n"))))
        pm = p.where("f_month")
        pm = pm.join(self.ws.peak_month(pm), "wkey")
        parts.append(row(pm, 7, _fmt(LINE_PEAK_MONTH, F.col("mes"), F.col("n"))))
        allp = reduce(DataFrame.unionByName, parts)
        w = Window.partitionBy("question_id").orderBy("g", "k1", "k2")
        return allp.select("question_id", F.row_number().over(w).alias("line_no"), "line")

    def stats_text(self) -> DataFrame:
        """(question_id, stats): lines joined by newlines ('' when none)."""
        lines = self.lines().groupBy("question_id").agg(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]),
            "\n").alias("stats"))
        return self.parsed.select("question_id").join(lines, "question_id", "left").select(
            "question_id", F.coalesce("stats", F.lit("")).alias("stats"))

    def global_summary(self) -> DataFrame:
        """One row over the whole table (no date window): totals and the top
        city, category and month, each as ``struct(neg_n, name)`` (ties by
        name). Built from the cube by one union and one global aggregate."""
        kinds = [("c", "ciudad"), ("k", "categoria_problema"), ("m", "mes")]
        long = reduce(DataFrame.unionByName, [
            self.cube.by(key).select(F.lit(kind).alias("kind"), F.col(key).alias("name"),
                                     "n", "n_urg") for kind, key in kinds])
        is_c = F.col("kind") == "c"
        aggs = [F.coalesce(F.sum(F.when(is_c, F.col("n"))), F.lit(0)).cast("long").alias("n_all"),
                F.coalesce(F.sum(F.when(is_c, F.col("n_urg"))), F.lit(0)).cast("long").alias("n_urg")]
        aggs += [F.min(F.when(F.col("kind") == kind, F.struct(
            (-F.col("n")).cast("long").alias("neg"), F.col("name").alias("name")))).alias(f"b_{kind}")
            for kind, _ in kinds]
        return long.agg(*aggs)

    def answers(self) -> DataFrame:
        """(question_id, answer) - first matching intent over the whole
        table (dates ignored); an empty group falls through. The one-row
        summary is materialized, so each value is a scalar read of it."""
        g = materialize(self.global_summary())
        n_all, n_urg = g.select("n_all").scalar(), g.select("n_urg").scalar()

        def best(kind):
            return g.select(f"b_{kind}.name").scalar(), g.select(-F.col(f"b_{kind}.neg")).scalar()

        (c_name, c_n), (k_name, k_n), (m_name, m_n) = best("c"), best("k"), best("m")
        p = self.parsed
        ans = (F.when(F.col("f_count") & F.col("f_urgent"), _fmt(ANSWER_URGENT_TOTAL, n_urg))
               .when(F.col("f_count"), _fmt(ANSWER_TOTAL, n_all))
               .when(F.col("f_answer_city") & c_name.isNotNull(), _fmt(ANSWER_TOP_CITY, c_name, c_n))
               .when(F.col("f_top_category") & k_name.isNotNull(),
                     _fmt(ANSWER_TOP_CATEGORY, k_name, k_n))
               .when(F.col("f_answer_month") & m_name.isNotNull(),
                     _fmt(ANSWER_PEAK_MONTH, m_name, m_n)))
        return p.select("question_id", ans.alias("answer")).where(F.col("answer").isNotNull())
