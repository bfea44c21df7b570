"""Column-level building blocks."""

from .dates import as_of_date, days_since, months_from_days, parse_release_date
from .flags import Bin, Bins, as_flag, bin_flags, bool_flags, parse_bool, value_set_flags
from .numbers import count_text, first_positive_count, parse_count, safe_double, whole
from .terms import TermIndex, term_literal
from .text import is_empty, normal_token, pad_text, strip

__all__ = [
    "Bin",
    "Bins",
    "TermIndex",
    "as_flag",
    "as_of_date",
    "bin_flags",
    "bool_flags",
    "count_text",
    "days_since",
    "first_positive_count",
    "is_empty",
    "months_from_days",
    "normal_token",
    "pad_text",
    "parse_bool",
    "parse_count",
    "parse_release_date",
    "safe_double",
    "strip",
    "term_literal",
    "value_set_flags",
    "whole",
]
