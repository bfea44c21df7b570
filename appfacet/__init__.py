"""Listing features on Spark: hydrate, validate, impute and enrich listing tables."""

from .operators.categories import (
    description_categories,
    genre_categories,
    summary_categories,
    with_categories,
)
from .operators.facets import (
    age_features,
    category_features,
    install_features,
    pricing_features,
    rating_features,
    score_features,
)
from .operators.impute import impute_listing_metrics
from .operators.lookup import hydrate, map_supplement
from .operators.spread import attach_features
from .operators.tagging import genre_table_categories, tag_with_rule_table, with_table_categories
from .operators.validity import split_valid
from .plans.enrich import EnrichResult, enrich_keys, enrich_listings
from .sources.rules import CategoryRules, default_rules, rules_from_document, rules_from_frame

__all__ = [
    "CategoryRules",
    "EnrichResult",
    "age_features",
    "attach_features",
    "category_features",
    "default_rules",
    "description_categories",
    "enrich_keys",
    "enrich_listings",
    "genre_categories",
    "genre_table_categories",
    "hydrate",
    "impute_listing_metrics",
    "install_features",
    "map_supplement",
    "pricing_features",
    "rating_features",
    "rules_from_document",
    "rules_from_frame",
    "score_features",
    "split_valid",
    "summary_categories",
    "tag_with_rule_table",
    "with_categories",
    "with_table_categories",
]
