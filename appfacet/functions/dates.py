"""Release dates and ages."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

from .text import as_column

# The accepted release-date shapes with their datetime patterns, in
# the order they are tried, and the mean length of a month in days.
RELEASE_FORMATS = (
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}\z", "MMM d, yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    (r"^[A-Za-z]+ \d{1,2}, \d{4}\z", "MMMM d, yyyy"),
)
DAYS_PER_MONTH = 30.44


def parse_release_date(value: Column | str) -> Column:
    """Read a release date; NULL when no format fits or the day does not exist.

    Runs of white space between the parts are accepted, at the ends they are not.
    """
    text = F.regexp_replace(as_column(value).cast("string"), r"(?U)\s+", " ")
    return F.coalesce(
        *[
            F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(fmt)).cast("date"))
            for shape, fmt in RELEASE_FORMATS
        ]
    )


def as_of_date(as_of: datetime.date | str | Column | None) -> Column:
    """The reference day as a date column; by default today's date in UTC."""
    if as_of is None:
        return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("date")
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def days_since(day: Column, as_of: datetime.date | str | Column | None = None) -> Column:
    """Whole days from ``day`` to ``as_of``, at least 0; NULL for a NULL day."""
    age = F.date_diff(as_of_date(as_of), day)
    # GREATEST skips NULL, so the zero is made from the age itself.
    return F.greatest(age, age * F.lit(0))


def months_from_days(days: Column) -> Column:
    """Completed months of a number of days."""
    return (days / F.lit(DAYS_PER_MONTH)).try_cast("bigint")
