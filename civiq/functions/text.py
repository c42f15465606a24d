"""Column expressions for text: trimming, accent folding, tokens, LIKE.

All of them are built-in Spark expressions (regexp_replace, translate,
regexp_extract_all, like), so they stay JVM-side inside whole-stage codegen.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace as Python's str.isspace() defines it (Java's and RE2's
# \s are narrower). Written with \x{..} escapes that both Java regex and RE2
# read the same way.
WS_CLASS = (
    r"\t\n\x0B\x0C\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# Python's \w: letters, numbers and underscore.
WORD_CLASS = r"\p{L}\p{N}_"
# Index token: a run of letters or digits (underscore splits tokens).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"

# Python's whitespace characters (str.isspace), derived by rule; all lie
# below U+3001.
WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _build_fold_table() -> tuple[str, str]:
    """Accent-folding table, derived by rule from Unicode decomposition.

    A character maps to its canonical decomposition with the non-spacing marks
    removed, when that leaves exactly one other character. Covered: Latin-1
    Supplement, Latin Extended-A/B and Latin Extended Additional, Greek and
    Cyrillic. Bare combining marks (U+0300..U+036F) are deleted.
    """
    ranges = [(0x00C0, 0x024F), (0x0370, 0x03FF), (0x0400, 0x04FF), (0x1E00, 0x1EFF)]
    src, dst = [], []
    for lo, hi in ranges:
        for cp in range(lo, hi + 1):
            ch = chr(cp)
            base = "".join(c for c in unicodedata.normalize("NFD", ch)
                           if unicodedata.category(c) != "Mn")
            if len(base) == 1 and base != ch:
                src.append(ch)
                dst.append(base)
    marks = [chr(cp) for cp in range(0x0300, 0x0370)]
    return "".join(src) + "".join(marks), "".join(dst)


FOLD_FROM, FOLD_TO = _build_fold_table()


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Strip Unicode whitespace at both ends (Python ``str.strip``): a
    character-set trim, no regex."""
    return F.btrim(col_(c), F.lit(WS_CHARS))


def strip_accents(c: Column | str) -> Column:
    """Remove diacritics: decomposed form without non-spacing marks."""
    return F.translate(col_(c), FOLD_FROM, FOLD_TO)


def fold(c: Column | str) -> Column:
    """Lower-case, then strip accents (the search and mention normal form)."""
    return strip_accents(F.lower(col_(c)))


def tokenize(c: Column | str) -> Column:
    """Index tokens of a text: folded runs of letters and digits.

    A null text has no tokens (empty array), like an empty column.
    """
    return F.coalesce(
        F.regexp_extract_all(fold(c), F.lit(TOKEN_PATTERN), 0),
        F.array().cast("array<string>"),
    )


def sanitize_query(c: Column | str) -> Column:
    """Query sanitizer: non-word characters to spaces, squeeze, strip."""
    s = F.regexp_replace(col_(c), rf"[^{WORD_CLASS}{WS_CLASS}]", " ")
    s = F.regexp_replace(s, rf"[{WS_CLASS}]+", " ")
    return strip_ws(s)


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z only (the case folding of SQL LIKE in the source store)."""
    return F.translate(col_(c), ASCII_UPPER, ASCII_LOWER)


def like_contains_pattern(q: Column | str) -> Column:
    """``%q%`` for Spark LIKE: backslash (Spark's escape) doubled, ``%``/``_``
    left as wildcards, ASCII case folded."""
    escaped = F.regexp_replace(ascii_lower(q), r"\\", r"\\\\")
    return F.concat(F.lit("%"), escaped, F.lit("%"))


def contains_any(c: Column, words: list[str]) -> Column:
    """True when ``c`` holds any of the words as a substring."""
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def windows_of(c: Column, n: int) -> Column:
    """All substrings of n letters in order (none of a shorter text). A
    look-ahead finds them in one pass; substring() would count its way from the
    text's start each time."""
    return F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))


def text_grams(c: Column, lengths: list[int]) -> Column:
    """The substrings of these lengths (0: the empty one), repeats included."""
    parts = [windows_of(c, k) if k else F.array(F.lit("")) for k in lengths]
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def name_grams(c: Column, n: int) -> Column:
    """The distinct substrings of n letters; a shorter text is its own gram."""
    return F.when(F.length(c) < n, F.array(c)).otherwise(F.array_distinct(windows_of(c, n)))
