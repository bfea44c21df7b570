"""Lenient number parsing: what cannot be read is NULL, never an error or NaN."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import as_column

# The accepted number format and the characters dropped from counts.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
COUNT_JUNK_PATTERN = r"(?U)[,+\s]"


def safe_double(value: Column | str) -> Column:
    """Parse text as a finite double.

    The pattern keeps out forms that a cast would take (``nan``, ``inf``, ``1d``).
    """
    text = as_column(value).cast("string")
    number = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def count_text(value: Column | str) -> Column:
    """Remove thousands separators, plus signs and white space."""
    return F.regexp_replace(as_column(value).cast("string"), COUNT_JUNK_PATTERN, "")


def parse_count(value: Column | str, fallback: Column | str | None = None) -> Column:
    """Parse a count such as ``1,000,000+``; fall back to a plain number column."""
    parsed = safe_double(count_text(value))
    return parsed if fallback is None else F.coalesce(parsed, safe_double(fallback))


def first_positive_count(*values: Column | str) -> Column:
    """The first of several count texts that reads as a number above zero."""
    parsed = [safe_double(count_text(v)) for v in values]
    return F.coalesce(*[F.when(p > 0, p) for p in parsed])


def whole(value: Column) -> Column:
    """Drop the fraction of a double; of any size."""
    return value - value % F.lit(1.0)


def count_to_text(value: Column) -> Column:
    """A whole double as digits; above 38 digits, in the double's own form."""
    digits = value.try_cast("decimal(38,0)").cast("string")
    return F.coalesce(digits, value.cast("string"))
