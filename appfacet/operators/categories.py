"""Category flags from the genre, the summary and the description of a listing."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.flags import as_flag
from ..functions.terms import TermIndex, literal_map, with_labels
from ..functions.text import as_column, strip
from ..sources.rules import CategoryRules, default_rules
from .columns import column_or, find_column

GENRE, SUMMARY, DESCRIPTION = "__genre", "__summary_labels", "__description_labels"
CATEGORIES = "categories"


def genre_code(value: Column | str) -> Column:
    """Stripped upper-case genre; what is not text has none."""
    return F.upper(strip(value))


def genre_categories(value: Column | str, rules: CategoryRules | None = None) -> Column:
    """Phase 1: array of the categories a genre stands for; empty when unknown."""
    rules = rules or default_rules()
    none = F.array().cast("array<string>")
    if not rules.genres:
        return none
    code = F.coalesce(genre_code(value), F.lit(""))
    return F.coalesce(F.try_element_at(literal_map(rules.genres), code), none)


def keyword_categories(value: Column | str, index: TermIndex) -> Column:
    """Phase 2: array of the categories whose terms occur in a text."""
    return index.tag(as_column(value))


def summary_categories(value: Column | str, rules: CategoryRules | None = None) -> Column:
    return keyword_categories(value, (rules or default_rules()).summary_index)


def description_categories(value: Column | str, rules: CategoryRules | None = None) -> Column:
    return keyword_categories(value, (rules or default_rules()).description_index)


def with_phases(df: DataFrame, rules: CategoryRules) -> DataFrame:
    """Add the genre code and the label arrays of both text phases as scratch columns.

    Absent text columns count as empty, as does an absent genre.
    """
    none = F.lit(None).cast("string")
    exact = "genreId" if "genreId" in df.columns else "genreid"
    df = df.withColumn(GENRE, genre_code(column_or(df, exact, none)))
    indexes = {
        SUMMARY: ("summary", rules.summary_index),
        DESCRIPTION: ("description", rules.description_index),
    }
    targets = {
        name: (find_column(df, column), index)
        for name, (column, index) in indexes.items()
        if index.labels and find_column(df, column)
    }
    df = with_labels(df, targets) if targets else df
    absent = [name for name in indexes if name not in targets]
    return df.withColumns({name: F.array().cast("array<string>") for name in absent})


def phase_hits(category: str, rules: CategoryRules) -> tuple[Column, Column, Column]:
    """Whether each of the three phases gives the category; never NULL."""
    genres = [g for g, cats in rules.genres.items() if category in cats]
    by_genre = F.coalesce(F.col(GENRE).isin(genres), F.lit(False)) if genres else F.lit(False)
    return (
        by_genre,
        F.array_contains(SUMMARY, category),
        F.array_contains(DESCRIPTION, category),
    )


def category_flags(rules: CategoryRules) -> dict[str, Column]:
    """One flag per category, over the columns of ``with_phases``: any phase is enough."""
    return {c: as_flag(reduce(or_, phase_hits(c, rules))) for c in rules.categories}


def with_categories(df: DataFrame, rules: CategoryRules | None = None) -> DataFrame:
    """Add ``categories``: the union of the three phases as one array."""
    rules = rules or default_rules()
    tagged = with_phases(df, rules)
    by_genre = genre_categories(F.col(GENRE), rules)
    union = F.array_union(by_genre, F.array_union(F.col(SUMMARY), F.col(DESCRIPTION)))
    return tagged.withColumn(CATEGORIES, union).drop(GENRE, SUMMARY, DESCRIPTION)
