"""Reusable column expressions (all built-in Spark functions)."""

from .dates import month_key, month_ordinal, ordinal_to_month, parse_date_iso
from .numeric import to_flag, to_int_half_even, to_number
from .text import (
    ascii_lower,
    contains_any,
    fold,
    like_contains_pattern,
    sanitize_query,
    strip_accents,
    strip_ws,
    tokenize,
)

__all__ = [
    "ascii_lower", "contains_any", "fold", "like_contains_pattern", "month_key",
    "month_ordinal", "ordinal_to_month", "parse_date_iso", "sanitize_query",
    "strip_accents", "strip_ws", "to_flag", "to_int_half_even", "to_number", "tokenize",
]
