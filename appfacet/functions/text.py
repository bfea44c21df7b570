"""Text primitives as ``Column -> Column`` expressions (built-ins only)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as white space when a text is stripped.
WHITESPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),  # tab, line feed, vertical tab, form feed, return
            *range(0x1C, 0x21),  # the four separators and the space
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Drop Unicode white space at both ends (``trim`` alone drops only spaces)."""
    return F.btrim(as_column(value).cast("string"), F.lit(WHITESPACE))


def is_empty(value: Column | str) -> Column:
    """TRUE for NULL and for blank text; never NULL.

    Trimming on the left stops at the first visible character, so the test does
    not walk through long texts.
    """
    text = as_column(value).cast("string")
    return F.coalesce(F.ltrim(text, F.lit(WHITESPACE)) == "", F.lit(True))


def normal_token(value: Column | str) -> Column:
    """Stripped lower-case form used to compare short tokens."""
    return F.lower(strip(value))


def pad_text(value: Column | str) -> Column:
    """Lower-case, strip, then put one space on either side."""
    return F.concat(F.lit(" "), strip(F.lower(as_column(value))), F.lit(" "))
