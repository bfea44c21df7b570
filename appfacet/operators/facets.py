"""The six feature families: each takes a frame and returns the key and its flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import months_from_days
from ..functions.flags import bin_flags, bool_flags, parse_bool, value_set_flags
from ..functions.numbers import parse_count, safe_double
from ..functions.text import normal_token
from ..schema import (
    AGE_BINS,
    INSTALL_BINS,
    KEY,
    PRICING_FLAGS,
    RATING_MISSING,
    RATING_OTHER,
    RATING_VALUES,
    SCORE_BINS,
)
from ..sources.rules import CategoryRules, default_rules
from .categories import category_flags, with_phases
from .columns import as_text, column_or

MONTHS = "months_since_launch"
DAYS = "days_since_released"
_PARSED = "__parsed"


# --- parsed inputs ---------------------------------------------------------
def score_number(df: DataFrame) -> Column:
    return safe_double("score")


def install_number(df: DataFrame) -> Column:
    """Install count, from ``min_installs`` where it cannot be read and that exists."""
    return parse_count("installs", "min_installs" if "min_installs" in df.columns else None)


def derived_months(df: DataFrame) -> Column:
    """Months from the age in days; NULL if there is no such column."""
    if DAYS not in df.columns:
        return F.lit(None).cast("bigint")
    return months_from_days(safe_double(DAYS))


def months_number(
    df: DataFrame, policy: str = "dataset", scope: DataFrame | None = None, given: bool | None = None
) -> Column:
    """Months since launch.

    Without a months column the value is derived from the days. With one, the policy
    decides: ``"dataset"`` takes that column for all rows if any row of ``scope``
    (default: ``df``) has a number in it, ``"row"`` derives only where it is missing.
    The dataset policy is an EXISTS subquery, which stops at the first number found, or
    ``given`` where the answer is known; it does not apply to streams.
    """
    if policy not in ("dataset", "row"):
        raise ValueError(f"unknown months policy {policy!r}: use 'dataset' or 'row'")
    if MONTHS not in df.columns:
        return derived_months(df)
    own, derived = safe_double(MONTHS), derived_months(df).cast("double")
    if policy == "row":
        return F.coalesce(own, derived)
    if given is not None:
        return own if given else derived
    scope = df if scope is None else scope
    if scope.isStreaming:
        raise ValueError("months policy 'dataset' needs a finite table: use 'row' on streams")
    any_given = scope.where(safe_double(MONTHS).isNotNull()).select(F.lit(1)).exists()
    return F.when(any_given, own).otherwise(derived)


def free_value(df: DataFrame) -> Column:
    return parse_bool("free")


def iap_value(df: DataFrame) -> Column:
    """Column ``offers_iap`` in any letter case; unknown for all rows if absent."""
    return parse_bool(column_or(df, "offers_iap", F.lit(None).cast("string")))


# --- flags -----------------------------------------------------------------
def pricing_columns(free: Column, iap: Column) -> dict[str, Column]:
    is_free, is_paid, has_iap, no_iap = PRICING_FLAGS
    return bool_flags(free, is_free, is_paid) | bool_flags(iap, has_iap, no_iap)


def rating_columns(token: Column) -> dict[str, Column]:
    return value_set_flags(token, RATING_VALUES, RATING_MISSING, RATING_OTHER)


# --- families --------------------------------------------------------------
def _texts(df: DataFrame) -> DataFrame:
    """The columns as text, so that typed tables follow the rules of delimited ones."""
    return as_text(df)


def _family(df: DataFrame, parsed: dict[str, Column], flags: dict[str, Column]) -> DataFrame:
    return df.select(KEY, *[c.alias(n) for n, c in parsed.items()]).select(
        KEY, *[c.alias(n) for n, c in flags.items()]
    )


def score_features(df: DataFrame) -> DataFrame:
    df = _texts(df)
    return _family(df, {_PARSED: score_number(df)}, bin_flags(F.col(_PARSED), SCORE_BINS))


def install_features(df: DataFrame) -> DataFrame:
    df = _texts(df)
    return _family(df, {_PARSED: install_number(df)}, bin_flags(F.col(_PARSED), INSTALL_BINS))


def age_features(df: DataFrame, months_policy: str = "dataset") -> DataFrame:
    df = _texts(df)
    months = months_number(df, months_policy)
    return _family(df, {_PARSED: months}, bin_flags(F.col(_PARSED), AGE_BINS))


def pricing_features(df: DataFrame) -> DataFrame:
    df = _texts(df)
    parsed = {"__free": free_value(df), "__iap": iap_value(df)}
    return _family(df, parsed, pricing_columns(F.col("__free"), F.col("__iap")))


def rating_features(df: DataFrame) -> DataFrame:
    df = _texts(df)
    return _family(
        df, {_PARSED: normal_token("content_rating")}, rating_columns(F.col(_PARSED))
    )


def category_features(df: DataFrame, rules: CategoryRules | None = None) -> DataFrame:
    rules = rules or default_rules()
    flags = category_flags(rules)
    return with_phases(df, rules).select(KEY, *[c.alias(n) for n, c in flags.items()])


def all_features(
    df: DataFrame,
    rules: CategoryRules | None = None,
    months_policy: str = "dataset",
    scope: DataFrame | None = None,
    months_given: bool | None = None,
) -> DataFrame:
    """Append the flags of all families, and ``months_since_launch`` as a number.

    Inputs are parsed in one projection and flags are made in the next, on the same
    row: there is no join and no shuffle.
    """
    rules = rules or default_rules()
    parsed = {
        "__score": score_number(df),
        "__installs": install_number(df),
        MONTHS: months_number(df, months_policy, scope, months_given),
        "__free": free_value(df),
        "__iap": iap_value(df),
        "__rating": normal_token("content_rating"),
    }
    flags = (
        category_flags(rules)
        | bin_flags(F.col("__score"), SCORE_BINS)
        | bin_flags(F.col("__installs"), INSTALL_BINS)
        | bin_flags(F.col(MONTHS), AGE_BINS)
        | pricing_columns(F.col("__free"), F.col("__iap"))
        | rating_columns(F.col("__rating"))
    )
    return with_phases(df.withColumns(parsed), rules).withColumns(flags)
