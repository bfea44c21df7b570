"""Split of listings into valid and invalid rows."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import is_empty
from ..schema import KEY, REQUIRED_COLUMNS
from .columns import cell


def count_false(conditions: Iterable[Column]) -> Column:
    """How many of some never-NULL conditions fail.

    One comparison of a count keeps a filter on many columns a single predicate, which
    the optimizer handles faster than a chain of them.
    """
    return reduce(add, [(~c).cast("int") for c in conditions], F.lit(0))


def any_empty(columns: Iterable[str]) -> Column:
    return count_false(~is_empty(c) for c in columns) > 0


def valid_row(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> Column:
    """TRUE where no required field is empty; FALSE everywhere if a column is absent."""
    required = list(required)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if not set(required) <= kinds.keys():
        return F.lit(False)
    return count_false(~is_empty(cell(c, kinds[c])) for c in required) == 0


def split_valid(
    df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint frames that together hold every input row."""
    valid = valid_row(df, required)
    return df.where(valid), df.where(~valid)


def needs_lookup(required: Iterable[str] = REQUIRED_COLUMNS, key: str = KEY) -> Column:
    """TRUE for rows with a key and at least one empty required field."""
    return any_empty(required) & ~is_empty(key)
