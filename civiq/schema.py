"""Schemas and fixed values of the report data model.

Everything under "FIXED VALUES" must stay exactly as written: the cleaning
rules, question parsing and prompt text are defined by these literals, and
changing any of them changes results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source application's for identical results)
# ---------------------------------------------------------------------------

# Raw CSV header -> clean column name.
COLUMN_RENAME_MAP = {
    "ID": "id",
    "Nombre": "nombre",
    "Edad": "edad",
    "Género": "genero",
    "Ciudad": "ciudad",
    "Comentario": "comentario",
    "Categoría del problema": "categoria_problema",
    "Nivel de urgencia": "nivel_urgencia",
    "Fecha del reporte": "fecha_reporte",
    "Acceso a internet": "acceso_internet",
    "Atención previa del gobierno": "atencion_previa_gobierno",
    "Zona rural": "zona_rural",
}

# Fields that must be non-null after cleaning (plus the derived `urgente`).
REQUIRED_FIELDS = [
    "nombre",
    "edad",
    "genero",
    "ciudad",
    "comentario",
    "categoria_problema",
    "nivel_urgencia",
    "fecha_reporte",
    "acceso_internet",
    "atencion_previa_gobierno",
    "zona_rural",
]

# Cells equal to one of these (untrimmed) are missing values at read time:
# the five explicit markers followed by the CSV reader's default set.
NA_MARKERS = [
    "", "NA", "NaN", "null", "None",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NULL", "n/a", "nan",
]

# Gender: exact value map, anything else is missing.
GENERO_MAP = {"M": "M", "F": "F", "Otro": "Otro", "O": "Otro"}

# Urgency labels (compared trimmed and lower-cased).
URGENT_LABELS = ["urgente", "alta", "alta urgencia"]
NOT_URGENT_LABELS = ["no urgente", "baja", "baja urgencia"]

# Comment values (trimmed, lower-cased) that mean "no comment".
COMMENT_NULL_MARKERS = ["", "nan", "none", "null"]

# Flag columns that must hold 0 or 1.
FLAG_COLUMNS = ["acceso_internet", "atencion_previa_gobierno", "zona_rural"]

# Date styles (patterns of the day), and the time and zone that may follow.
DATE_YEAR_FIRST = r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})"
DATE_YEAR_LAST = r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})"
DATE_DIGITS = r"^(\d{4})(\d{2})(\d{2})"
_MONTH = r"(jan|january|feb|february|mar|march|apr|april|may|jun|june|jul|july|aug|august|sep|september|oct|october|nov|november|dec|december)"
DATE_MONTH_FIRST = rf"^{_MONTH}[ -](\d{{1,2}}),?[ -](\d{{4}})"
DATE_DAY_MONTH = rf"^(\d{{1,2}})[ -]{_MONTH},?[ -](\d{{4}})"
DATE_TIME = (r"(?:[ Tt](?:(?:[01]?\d|2[0-3]):[0-5]?\d(?::[0-5]?\d(?:\.\d{1,9})?)?"
             r"|(?:0?[1-9]|1[0-2]):[0-5]\d(?::[0-5]\d(?:\.\d{1,9})?)? ?[AaPp][Mm])(?:[Zz]| ?[+-]\d{2}:?\d{2})?)?")
MONTHS_SHORT = "janfebmaraprmayjunjulaugsepoctnovdec"

# Numeric columns of the correlation matrix, in order.
CORRELATION_COLUMNS = [
    "edad", "acceso_internet", "atencion_previa_gobierno", "zona_rural", "urgente",
]

# Spanish month names in the order they are tried, with their month number.
MONTHS_ES = [
    ("enero", "01"), ("febrero", "02"), ("marzo", "03"), ("abril", "04"),
    ("mayo", "05"), ("junio", "06"), ("julio", "07"), ("agosto", "08"),
    ("septiembre", "09"), ("setiembre", "09"), ("octubre", "10"),
    ("noviembre", "11"), ("diciembre", "12"),
]

# Question intent words (substring tests on the lower-cased question).
COUNT_WORDS = ["cuant", "cantidad"]
RECORD_WORDS = ["registro", "registros", "reporte", "reportes"]
URGENT_WORDS = ["urgente", "urgentes"]
MORE_WORDS = ["más", "mas"]
CITY_WORD = "ciudad"
CATEGORY_WORD = "categor"
MONTH_WORD = "mes"

# Statistics line formats.
LINE_TOTAL_URGENT = "Total urgentes: {}"
LINE_TOTAL = "Total registros: {}"
LINE_CITY = "Ciudad: {}; registros: {}"
LINE_CATEGORY = "Categoría: {}; registros: {}"
LINE_URGENT_SUFFIX = "; urgentes: {}"
LINE_TOP_CITY = "Top ciudad por registros: {} ({})"
LINE_TOP_CATEGORY = "Top categoría por registros: {} ({})"
LINE_PEAK_MONTH = "Mes pico de registros: {} ({})"

# Direct numeric answers.
ANSWER_URGENT_TOTAL = "Hay {} reportes urgentes en total."
ANSWER_TOTAL = "Hay {} registros en total."
ANSWER_TOP_CITY = "La ciudad con más reportes es {} con {} registros."
ANSWER_TOP_CATEGORY = "La categoría con más reportes es {} con {} registros."
ANSWER_PEAK_MONTH = "El mes con más reportes es {} con {} registros."

# Context line of one retrieved report.
CONTEXT_LINE = "- id={} fecha={} ciudad={} categoria={} urgente={}: {}"

# Prompt text.
PROMPT_SYSTEM = (
    "Eres un analista cívico. Responde EXCLUSIVAMENTE en español (español neutro) y "
    "EXCLUSIVAMENTE con base en el Contexto de reportes ciudadanos proveniente de la base SQLite indicada cuando exista. "
    "No inventes datos ni cifras; evita usar conocimientos externos. "
    "Cita IDs relevantes solo si hay contexto. Si el Contexto está vacío, ofrece una respuesta breve y general sin datos concretos. "
    "Si hay Estadísticas agregadas, utilízalas para sustentar números y proporciones. "
    "Si la pregunta viene en otro idioma, tradúcela y responde en español. No incluyas texto en inglés."
)
PROMPT_INSTRUCTIONS = (
    "Responde ÚNICAMENTE en español y limita tus afirmaciones al Contexto anterior cuando esté disponible. "
    "Usa también las Estadísticas agregadas si están presentes para respaldar números. "
    "Devuelve hallazgos y conclusiones basadas en ese Contexto y cita IDs solo si aplica. "
    "No repitas los encabezados 'Contexto:' ni 'Pregunta:' ni el contenido del prompt; "
    "entrega la respuesta directamente en un párrafo o lista concisa."
)
PROMPT_CONTEXT_HEADER = "Contexto:"
PROMPT_STATS_HEADER = "Estadísticas agregadas:"
PROMPT_QUESTION_HEADER = "Pregunta:"

# Search defaults.
DEFAULT_TOP_K = 8
BM25_K1 = 1.2
BM25_B = 0.75
BM25_MIN_IDF = 1e-6

# Analysis defaults.
TOP_CATEGORIES = 15
TOP_CITIES = 15
CROSSTAB_TOP_CITIES = 12
CROSSTAB_TOP_CATEGORIES = 12
URGENT_LABEL_0 = "No urgente (0)"
URGENT_LABEL_1 = "Urgente (1)"

# Clean report columns in order, and their types.

REPORT_COLUMNS = [
    "id",
    "nombre",
    "edad",
    "genero",
    "ciudad",
    "comentario",
    "categoria_problema",
    "nivel_urgencia",
    "urgente",
    "fecha_reporte",
    "acceso_internet",
    "atencion_previa_gobierno",
    "zona_rural",
]

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("nombre", T.StringType(), False),
        T.StructField("edad", T.IntegerType(), False),
        T.StructField("genero", T.StringType(), False),
        T.StructField("ciudad", T.StringType(), False),
        T.StructField("comentario", T.StringType(), False),
        T.StructField("categoria_problema", T.StringType(), False),
        T.StructField("nivel_urgencia", T.StringType(), False),
        T.StructField("urgente", T.IntegerType(), False),
        T.StructField("fecha_reporte", T.StringType(), False),
        T.StructField("acceso_internet", T.IntegerType(), False),
        T.StructField("atencion_previa_gobierno", T.IntegerType(), False),
        T.StructField("zona_rural", T.IntegerType(), False),
    ]
)

RAW_COLUMNS = list(COLUMN_RENAME_MAP.keys())

# Columns a search hit carries.
HIT_COLUMNS = ["id", "comentario", "ciudad", "categoria_problema", "fecha_reporte", "urgente"]
