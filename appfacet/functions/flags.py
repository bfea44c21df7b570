"""0/1 flag columns from declarative specs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from .text import as_column, normal_token


@dataclass(frozen=True)
class Bin:
    """One interval; an open end is None."""

    name: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Bins:
    """Adjoining intervals in output order plus the flag for missing numbers.

    ``closed`` tells which end belongs to an interval: ``"left"`` or ``"right"``.
    """

    bins: tuple[Bin, ...]
    missing: str
    closed: str = "left"

    @property
    def names(self) -> list[str]:
        return [b.name for b in self.bins] + [self.missing]


def as_flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def bin_flags(number: Column, spec: Bins) -> dict[str, Column]:
    """One flag per interval; exactly one flag is 1 on every row."""
    flags = {}
    for b in spec.bins:
        inside = number.isNotNull()
        if b.low is not None:
            low = F.lit(float(b.low))
            inside &= (number >= low) if spec.closed == "left" else (number > low)
        if b.high is not None:
            high = F.lit(float(b.high))
            inside &= (number < high) if spec.closed == "left" else (number <= high)
        flags[b.name] = as_flag(inside)
    flags[spec.missing] = number.isNull().cast("int")
    return flags


def value_set_flags(
    token: Column,
    rules: Mapping[str, Iterable[str]],
    missing: str,
    other: str,
) -> dict[str, Column]:
    """Flags of a normal token: one per value set, one for no value, one for the rest."""
    present = F.coalesce(token != "", F.lit(False))
    known = [v for values in rules.values() for v in values]
    flags = {name: as_flag(token.isin(list(values))) for name, values in rules.items()}
    flags[missing] = (~present).cast("int")
    flags[other] = as_flag(present & ~token.isin(known))
    return flags


# The tokens read as true and as false.
TRUE_TOKENS = ("true", "1", "yes")
FALSE_TOKENS = ("false", "0", "no")


def parse_bool(value: Column | str) -> Column:
    """Three-valued boolean of a text token; anything unlisted is NULL."""
    token = normal_token(as_column(value))
    return F.when(token.isin(*TRUE_TOKENS), F.lit(True)).when(
        token.isin(*FALSE_TOKENS), F.lit(False)
    )


def bool_flags(value: Column, when_true: str, when_false: str) -> dict[str, Column]:
    """A pair of flags; both are 0 where the value is unknown."""
    return {when_true: as_flag(value), when_false: as_flag(~value)}
