"""Column names of listing tables and of the features derived from them."""

from __future__ import annotations

from .functions.flags import Bin, Bins

KEY = "bundle_id"

# ---------------------------------------------------------------------------
# Names, edges and value sets that define the output.
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = (
    "bundle_id",
    "description",
    "summary",
    "genreid",
    "content_rating",
    "score",
    "ratings_count",
    "installs",
    "developerid",
    "developer",
    "free",
    "offers_iap",
    "days_since_released",
)
FILLABLE_COLUMNS = ("score", "ratings_count", "days_since_released")
PASSTHROUGH_COLUMNS = (*REQUIRED_COLUMNS, "months_since_launch")

SCORE_BINS = Bins(
    (
        Bin("score_45plus", low=4.5),
        Bin("score_40_45", low=4.0, high=4.5),
        Bin("score_30_40", low=3.0, high=4.0),
        Bin("score_below30", high=3.0),
    ),
    missing="score_missing",
)
INSTALL_BINS = Bins(
    (
        Bin("installs_10m_plus", low=10_000_000),
        Bin("installs_1m_10m", low=1_000_000, high=10_000_000),
        Bin("installs_100k_1m", low=100_000, high=1_000_000),
        Bin("installs_below100k", high=100_000),
    ),
    missing="installs_missing",
)
AGE_BINS = Bins(
    (
        Bin("apps_0_3months", high=3),
        Bin("apps_3_12months", low=3, high=12),
        Bin("apps_1_2years", low=12, high=24),
        Bin("apps_2plus_years", low=24),
    ),
    missing="app_age_missing",
    closed="right",
)
PRICING_FLAGS = ("is_free_app", "is_paid_app", "offers_iap_flag", "no_iap_flag")
RATING_VALUES = {
    "rating_everyone": ("everyone",),
    "rating_teen": ("teen",),
    "rating_mature": ("mature 17+",),
    "rating_everyone10plus": ("everyone 10+",),
    "rating_rated3plus": ("rated for 3+", "pegi 3"),
    "rating_rated7plus": ("rated for 7+", "pegi 7"),
    "rating_rated12plus": ("rated for 12+", "pegi 12"),
    "rating_rated16plus": ("rated for 16+", "pegi 16"),
    "rating_rated18plus": ("rated for 18+", "pegi 18"),
    "rating_adults18plus": ("adults only 18+",),
}
RATING_MISSING = "rating_missing"
RATING_OTHER = "rating_other"
# ---------------------------------------------------------------------------

BASE_FLAGS = (
    *SCORE_BINS.names,
    *INSTALL_BINS.names,
    *AGE_BINS.names,
    *PRICING_FLAGS,
    *RATING_VALUES,
    RATING_MISSING,
    RATING_OTHER,
)


def flag_columns(categories: tuple[str, ...]) -> tuple[str, ...]:
    """All flags in output order: categories first, then the fixed families."""
    return (*categories, *BASE_FLAGS)


def final_columns(categories: tuple[str, ...]) -> tuple[str, ...]:
    """The full output in order."""
    return (*PASSTHROUGH_COLUMNS, *flag_columns(categories))
