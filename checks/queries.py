"""Registered queries: each operator over the given tables, with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import appfacet as af
from appfacet.functions import (
    Bin,
    Bins,
    TermIndex,
    bin_flags,
    days_since,
    first_positive_count,
    is_empty,
    months_from_days,
    normal_token,
    pad_text,
    parse_bool,
    parse_count,
    parse_release_date,
    safe_double,
    strip,
    term_literal,
)
from appfacet.functions.terms import with_labels
from appfacet.operators import reports
from appfacet.operators.columns import (
    as_text,
    final_select,
    normalise_columns,
    passthrough,
)
from appfacet.operators.facets import derived_months
from appfacet.operators.impute import impute_listing_metrics, imputation_counts
from appfacet.operators.installs import install_resolution_counts, resolve_installs
from appfacet.operators.keys import rows_or_supplement
from appfacet.operators.lookup import hydrate, hydration_counts, map_supplement, one_per_key
from appfacet.operators.spread import attach_features
from appfacet.operators.validity import split_valid, valid_row
from appfacet.plans.enrich import enrich_keys, enrich_listings
from appfacet.schema import final_columns
from appfacet.sources.tables import NULL_TOKENS, nullify

from . import oracle as o
from .records import (
    AS_OF,
    app_records,
    app_records_with_months,
    all_records,
    key_table,
    listing_source,
    quoted,
    rules_sql,
    spark_pick,
    spread_table,
    table,
)
from .vocabulary import categories, terms

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under the name of its function, with its SQL twin."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        ORACLE[run.__name__] = o.with_ctes(sql)
        return run

    return register


def joined_labels(labels: Column) -> Column:
    return F.array_join(F.array_sort(labels), ",")


def supplement(spark, sf):
    return map_supplement(listing_source(spark, sf), AS_OF)


# --- numbers, dates, bins --------------------------------------------------
@query(f"SELECT bundle_id, {o.aliased(o.score_flags())} FROM app_records")
def score_bins(spark, sf):
    return af.score_features(app_records(spark, sf))


@query(f"SELECT bundle_id, {o.aliased(o.install_flags())} FROM app_records")
def install_bins(spark, sf):
    return af.install_features(app_records(spark, sf))


@query(f"SELECT bundle_id, {o.aliased(o.age_flags(o.derived_months()))} FROM app_records")
def age_bins(spark, sf):
    return af.age_features(app_records(spark, sf))


DATASET_MONTHS = (
    f"CASE WHEN (SELECT count({o.num('months_since_launch')}) FROM with_months) > 0 "
    f"THEN {o.num('months_since_launch')} ELSE {o.derived_months()} END"
)
ROW_MONTHS = f"coalesce({o.num('months_since_launch')}, CAST({o.derived_months()} AS DOUBLE))"


@query(f"SELECT bundle_id, {o.aliased(o.age_flags(DATASET_MONTHS))} FROM with_months")
def age_bins_months_of_dataset(spark, sf):
    return af.age_features(app_records_with_months(spark, sf), "dataset")


@query(f"SELECT bundle_id, {o.aliased(o.age_flags(ROW_MONTHS))} FROM with_months")
def age_bins_months_of_row(spark, sf):
    return af.age_features(app_records_with_months(spark, sf), "row")


BALANCE = ("balance_high", "balance_mid", "balance_low", "balance_negative")


def _balance_sql(owner, key, balance):
    flags = o.binned(balance, BALANCE, "balance_missing", (5000, 1000, 0))
    return f"SELECT '{owner}' AS owner, {key} AS owner_key, {o.aliased(flags)} FROM {owner}"


@query(
    _balance_sql("supplier", "s_suppkey", "s_acctbal")
    + " UNION ALL "
    + _balance_sql("customer", "c_custkey", "c_acctbal")
)
def balance_bins(spark, sf):
    high, mid, low, negative = BALANCE
    spec = Bins(
        (Bin(high, 5000), Bin(mid, 1000, 5000), Bin(low, 0, 1000), Bin(negative, None, 0)),
        missing="balance_missing",
    )

    def part(owner, key, balance):
        flags = bin_flags(F.col(balance), spec)
        return table(spark, sf, owner).select(
            F.lit(owner).alias("owner"),
            F.col(key).alias("owner_key"),
            *[c.alias(n) for n, c in flags.items()],
        )

    return part("supplier", "s_suppkey", "s_acctbal").union(
        part("customer", "c_custkey", "c_acctbal")
    )


PRICE_BANDS = ("price_up_to_1000", "price_up_to_1500", "price_above")


@query(
    "SELECT p_partkey, "
    + o.aliased(o.binned("p_retailprice", PRICE_BANDS, "price_missing", (1000, 1500), "right"))
    + " FROM part"
)
def retail_price_bins(spark, sf):
    first, second, above = PRICE_BANDS
    spec = Bins(
        (Bin(first, high=1000), Bin(second, 1000, 1500), Bin(above, low=1500)),
        missing="price_missing",
        closed="right",
    )
    flags = bin_flags(F.col("p_retailprice"), spec)
    return table(spark, sf, "part").select("p_partkey", *[c.alias(n) for n, c in flags.items()])


POSITIVE = ", ".join(
    f"CASE WHEN {o.count_number(c)} > 0 THEN {o.count_number(c)} END"
    for c in ("installs", "real_installs", "min_installs")
)


@query(
    f"""SELECT bundle_id, {o.num('score')} AS score_number, {o.count_number('installs')} AS parsed,
    coalesce({o.count_number('installs')}, {o.num('min_installs')}) AS parsed_or_minimum,
    coalesce({POSITIVE}) AS first_positive FROM app_records"""
)
def parse_counts(spark, sf):
    return app_records(spark, sf).select(
        "bundle_id",
        safe_double("score").alias("score_number"),
        parse_count("installs").alias("parsed"),
        parse_count("installs", "min_installs").alias("parsed_or_minimum"),
        first_positive_count("installs", "real_installs", "min_installs").alias("first_positive"),
    )


@query(
    f"""SELECT bundle_id, released, CAST({o.parsed_date('released')} AS STRING) AS release_date,
    CASE WHEN {o.parsed_date('released')} IS NOT NULL
    THEN {o.age_in_days(o.parsed_date('released'))} END AS days_since_released FROM all_records"""
)
def release_age(spark, sf):
    day = parse_release_date("released")
    return all_records(spark, sf).select(
        "bundle_id",
        "released",
        day.cast("string").alias("release_date"),
        days_since(day, AS_OF).cast("bigint").alias("days_since_released"),
    )


@query(
    f"""SELECT o_orderkey, CAST(trunc(CAST(date_diff('day', CAST(o_orderdate AS DATE),
    DATE '{AS_OF}') AS DOUBLE) / CAST(30.44 AS DOUBLE)) AS BIGINT) AS months FROM orders"""
)
def order_age_in_months(spark, sf):
    days = days_since(F.col("o_orderdate").cast("date"), AS_OF).cast("double")
    return table(spark, sf, "orders").select("o_orderkey", months_from_days(days).alias("months"))


# --- text and flags --------------------------------------------------------
@query(
    f"""SELECT bundle_id, {o.empty('description')} AS no_description, {o.empty('bundle_id')} AS no_key,
    {o.strip('summary')} AS stripped, {o.padded('summary')} AS padded,
    {o.token('content_rating')} AS rating_token FROM app_records"""
)
def text_forms(spark, sf):
    return app_records(spark, sf).select(
        "bundle_id",
        is_empty("description").alias("no_description"),
        is_empty("bundle_id").alias("no_key"),
        strip("summary").alias("stripped"),
        pad_text("summary").alias("padded"),
        normal_token("content_rating").alias("rating_token"),
    )


def _bool_sql(x):
    return f"CASE WHEN {o.token(x)} IN {o.TRUE} THEN TRUE WHEN {o.token(x)} IN {o.FALSE} THEN FALSE END"


@query(
    f"SELECT bundle_id, {_bool_sql('free')} AS is_free, {_bool_sql('offers_iap')} AS has_iap "
    "FROM app_records"
)
def parsed_booleans(spark, sf):
    return app_records(spark, sf).select(
        "bundle_id", parse_bool("free").alias("is_free"), parse_bool("offers_iap").alias("has_iap")
    )


@query(f"SELECT bundle_id, {o.aliased(o.pricing_flags())} FROM app_records")
def pricing_flags(spark, sf):
    return af.pricing_features(app_records(spark, sf))


@query(f"SELECT bundle_id, {o.aliased(o.rating_flags())} FROM app_records")
def rating_flags(spark, sf):
    return af.rating_features(app_records(spark, sf))


@query(
    "SELECT bundle_id, "
    + ", ".join(
        f"CASE WHEN {c} IN ({quoted(NULL_TOKENS)}) THEN NULL ELSE {c} END AS {c}"
        for c in ("score", "installs", "genreid")
    )
    + " FROM app_records"
)
def null_tokens(spark, sf):
    cells = app_records(spark, sf).select("bundle_id", "score", "installs", "genreid")
    return nullify(cells)


@query(
    f"""SELECT CAST(s_suppkey AS STRING) AS s_suppkey, s_name, CAST(s_nationkey AS STRING) AS s_nationkey,
    {o.number_text('s_acctbal')} AS s_acctbal FROM supplier"""
)
def supplier_as_text(spark, sf):
    return as_text(table(spark, sf, "supplier"))


# --- categories ------------------------------------------------------------
def _phase_labels(source, phase):
    conditions = {c: o.hits(c)[phase] for c in categories()}
    return f"SELECT bundle_id, {o.labels(conditions)} AS labels FROM {o.phased(source)}"


@query(_phase_labels("app_records", 0))
def genre_categories(spark, sf):
    labels = joined_labels(af.genre_categories("genreid"))
    return app_records(spark, sf).select("bundle_id", labels.alias("labels"))


@query(_phase_labels("app_records", 1))
def summary_tags(spark, sf):
    labels = joined_labels(af.summary_categories("summary"))
    return app_records(spark, sf).select("bundle_id", labels.alias("labels"))


@query(_phase_labels("app_records", 2))
def description_tags(spark, sf):
    tagged = with_labels(
        app_records(spark, sf), {"found": ("description", af.default_rules().description_index)}
    )
    return tagged.select("bundle_id", joined_labels(F.col("found")).alias("labels"))


@query(
    "SELECT doc_id, "
    + o.labels(
        {
            r: o.any_term("lower(text)", terms("description", r))
            for r in categories()
        }
    )
    + " AS labels FROM phrase_docs"
)
def document_tags(spark, sf):
    """Every whole document, each with one phrase of the vocabulary worked in."""
    phrases = terms("description")
    docs = spread_table(spark, sf, "documents").select(
        "doc_id",
        F.expr(f"text || ' ' || {spark_pick(phrases, f'doc_id % {len(phrases)}')}").alias("text"),
    )
    tagged = with_labels(docs, {"found": ("text", af.default_rules().description_index)})
    return tagged.select("doc_id", joined_labels(F.col("found")).alias("labels"))


# A small vocabulary of frequent tokens of the given texts, as a user would pass one.
FREQUENT = {
    "english": [("the", "word"), ("of", "word"), ("by the", "substring"), ("ing to", "substring")],
    "german": [("und", "word"), ("der", "word"), ("die", "word")],
    "romance": [("que", "word"), ("la", "word"), ("en la", "substring"), ("le de", "substring")],
    "suffix": [("tion", "substring"), ("ción", "substring"), ("keit", "substring")],
}


def _frequent_sql(source, key):
    conditions = {
        name: o.any_term("t", [f" {t} " if mode == "word" else t for t, mode in found])
        for name, found in FREQUENT.items()
    }
    return (
        f"SELECT {key}, {o.labels(conditions)} AS labels FROM "
        f"(SELECT {key}, {o.padded('text')} AS t FROM {source})"
    )


def _frequent_index():
    labels: dict[str, list[str]] = {}
    for name, found in FREQUENT.items():
        for term, mode in found:
            labels.setdefault(term_literal(term, mode), []).append(name)
    return TermIndex(labels)


@query(_frequent_sql("documents", "doc_id"))
def custom_terms_in_documents(spark, sf):
    tagged = with_labels(spread_table(spark, sf, "documents"), {"found": ("text", _frequent_index())})
    return tagged.select("doc_id", joined_labels(F.col("found")).alias("labels"))


@query(_frequent_sql("conversations", "conv_id, turn"))
def custom_terms_in_conversations(spark, sf):
    tagged = with_labels(table(spark, sf, "conversations"), {"found": ("text", _frequent_index())})
    return tagged.select("conv_id", "turn", joined_labels(F.col("found")).alias("labels"))


# --- rules that stay a table ------------------------------------------------
def _rule_frame(spark, sf):
    sql = rules_sql("split", 0, FREQUENT).replace("FROM benchmark", "FROM {benchmark}")
    return spark.sql(sql, benchmark=table(spark, sf, "benchmark"))


def _table_tags_sql(source, key):
    """Every text against every rule."""
    return f"""WITH rules AS ({rules_sql('string_split', 1, FREQUENT)}),
        literals AS (SELECT category, CASE WHEN mode = 'word' THEN ' ' || {o.strip('term')} || ' ' ELSE {o.strip('term')} END AS literal FROM rules),
        texts AS (SELECT {key}, {o.padded('text')} AS t FROM {source}),
        found AS (SELECT {key}, string_agg(DISTINCT category, ',' ORDER BY category) AS labels
            FROM texts JOIN literals ON contains(t, literal) GROUP BY ALL)
        SELECT x.*, coalesce(labels, '') AS labels FROM (SELECT {key} FROM {source}) x LEFT JOIN found USING ({key})"""


@query(_table_tags_sql("documents", "doc_id"))
def rule_table_tags(spark, sf):
    tagged = af.tag_with_rule_table(spread_table(spark, sf, "documents"), "text", _rule_frame(spark, sf))
    return tagged.select("doc_id", F.array_join("labels", ",").alias("labels"))


@query(_table_tags_sql("conversations", "conv_id, turn"))
def rule_table_tags_of_turns(spark, sf):
    """With frequent words split over several tasks."""
    tagged = af.tag_with_rule_table(
        table(spark, sf, "conversations"), "text", _rule_frame(spark, sf), hot_rows=100
    )
    return tagged.select("conv_id", "turn", F.array_join("labels", ",").alias("labels"))


@query(_phase_labels("app_records", 0))
def genre_table_categories(spark, sf):
    rules = af.default_rules().to_frame(spark)
    mapping = rules.where("phase = 'genre'").select(F.col("term").alias("genre"), "category")
    tagged = af.genre_table_categories(app_records(spark, sf), mapping)
    return tagged.select("bundle_id", joined_labels(F.col("categories")).alias("labels"))


@query(
    "SELECT bundle_id, "
    + o.labels({c: " OR ".join(o.hits(c)) for c in categories()})
    + f" AS labels FROM {o.phased('app_records')}"
)
def rule_table_categories(spark, sf):
    """The union of all phases with the default rules as a table."""
    tagged = af.with_table_categories(app_records(spark, sf), af.default_rules().to_frame(spark))
    return tagged.select("bundle_id", joined_labels(F.col("categories")).alias("labels"))


@query(f"SELECT bundle_id, {o.aliased(o.category_flags())} FROM {o.phased('app_records')}")
def category_flags(spark, sf):
    return af.category_features(app_records(spark, sf))


@query(
    "SELECT bundle_id, "
    + o.labels({c: " OR ".join(o.hits(c)) for c in categories()})
    + f" AS labels FROM {o.phased('app_records')}"
)
def category_union(spark, sf):
    tagged = af.with_categories(app_records(spark, sf))
    return tagged.select("bundle_id", joined_labels(F.col("categories")).alias("labels"))


def _breakdown_sql():
    rows = []
    for c in categories():
        p = [f"CAST({h} AS INTEGER)" for h in o.hits(c)]
        rows.append(
            f"SELECT '{c}' AS category, CAST(sum({p[0]}) AS BIGINT) AS p1, CAST(sum({p[1]}) AS BIGINT) AS p2a, "
            f"CAST(sum({p[2]}) AS BIGINT) AS p2b, count_if({' + '.join(p)} >= 2) AS multi, "
            f"count_if({' + '.join(p)} = 0) AS none FROM phased"
        )
    return " UNION ALL ".join(rows)


@query(
    "SELECT category, p1, p2a, p2b, CAST(multi AS BIGINT) AS multi, CAST(none AS BIGINT) AS none FROM ("
    f"WITH phased AS MATERIALIZED (SELECT * FROM {o.phased('app_records')}) {_breakdown_sql()})"
)
def phase_breakdown(spark, sf):
    return reports.phase_breakdown(app_records(spark, sf))


@query(
    f"""SELECT CAST(n - zero AS BIGINT) AS assigned, {o.percent('n - zero', 'n')} AS assigned_pct,
    CAST(zero AS BIGINT) AS unassigned, {o.percent('zero', 'n')} AS unassigned_pct FROM (
    SELECT count(*) AS n, count_if({' + '.join(categories())} = 0) AS zero FROM enriched)"""
)
def category_assignment(spark, sf):
    return enrich_listings(app_records(spark, sf)).category_assignment()


# --- validity --------------------------------------------------------------
@query(f"SELECT * FROM resolved WHERE {o.valid()}")
def valid_rows(spark, sf):
    return split_valid(resolve_installs(app_records(spark, sf)))[0]


@query(f"SELECT * FROM resolved WHERE NOT ({o.valid()})")
def invalid_rows(spark, sf):
    return enrich_listings(app_records(spark, sf)).invalid


@query(
    f"""SELECT total, invalid, {o.percent('invalid', 'total')} AS invalid_pct, total - invalid AS valid,
    {o.percent('total - invalid', 'total')} AS valid_pct FROM (SELECT count(*) AS total,
    CAST(count_if(NOT ({o.valid()})) AS BIGINT) AS invalid FROM resolved)"""
)
def validation_totals(spark, sf):
    return enrich_listings(app_records(spark, sf)).validation_totals()


@query(
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count_if({o.empty(c)}) AS BIGINT) AS n FROM resolved"
        for c in o.REQUIRED
    )
    + ") WHERE n > 0"
)
def validation_report(spark, sf):
    return enrich_listings(app_records(spark, sf)).validation_report()


@query("SELECT CAST(0 AS BIGINT) AS valid, count(*) AS invalid FROM app_records")
def absent_required_column(spark, sf):
    records = app_records(spark, sf).drop("summary")
    ok = valid_row(records)
    return records.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))


# --- lookup, installs, imputation ------------------------------------------
@query("SELECT * FROM supplement")
def supplement_fields(spark, sf):
    return supplement(spark, sf)


@query("SELECT * FROM supplement_one")
def supplement_per_key(spark, sf):
    one = one_per_key(supplement(spark, sf))
    return one.toDF(*[c.removeprefix("__") for c in one.columns])


@query("SELECT * FROM hydrated")
def hydrate_listings(spark, sf):
    return hydrate(app_records(spark, sf), supplement(spark, sf))


@query("SELECT * FROM hydrated")
def hydrate_listings_in_one_pass(spark, sf):
    return hydrate(app_records(spark, sf), supplement(spark, sf), one_pass=True)


NEEDS = "(" + " OR ".join(o.empty(c) for c in o.REQUIRED) + f") AND NOT {o.empty('bundle_id')}"


@query(
    f"""SELECT count(*) AS targets, CAST(count_if({o.strip('bundle_id')} IN
    (SELECT lookup_key FROM supplement_one)) AS BIGINT) AS fetched FROM app_records WHERE {NEEDS}"""
)
def hydration_counters(spark, sf):
    return hydration_counts(app_records(spark, sf), supplement(spark, sf))


@query("SELECT * FROM resolved")
def resolved_installs(spark, sf):
    return resolve_installs(app_records(spark, sf))


@query(
    f"""SELECT CAST(count_if(real > 0) AS BIGINT) AS from_real_installs,
    CAST(count_if(real IS NULL OR real <= 0) AS BIGINT) AS from_installs
    FROM (SELECT {o.num('real_installs')} AS real FROM app_records)"""
)
def install_resolution_counters(spark, sf):
    return install_resolution_counts(app_records(spark, sf))


@query(o.imputed("app_records"))
def impute_metrics(spark, sf):
    return impute_listing_metrics(app_records(spark, sf))


@query(
    "SELECT count(*) AS input_rows, CAST(sum("
    + " + ".join(f"CAST({o.empty(c)} AS INTEGER)" for c in ("score", "ratings_count", "days_since_released"))
    + ") AS BIGINT) AS filled_cells FROM app_records"
)
def imputation_counters(spark, sf):
    return imputation_counts(app_records(spark, sf))


# --- typed tables -----------------------------------------------------------
TYPED = (
    "CAST(c_custkey AS DOUBLE) AS bundle_id, CASE WHEN c_custkey % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS score, "
    "CAST(c_custkey % 3 AS DOUBLE) AS free, c_custkey % 2 = 0 AS offers_iap, CAST(NULL AS DOUBLE) AS ratings_count, "
    "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey END AS days_since_released"
)


def typed_customers(spark, sf):
    return table(spark, sf, "customer").selectExpr(*TYPED.split(", "))


@query(
    f"""SELECT CAST(c_custkey AS BIGINT) AS custkey, c_custkey % 5 <> 0 AND c_custkey % 7 <> 0 AS ok FROM customer"""
)
def split_typed_customers(spark, sf):
    """NaN and NULL of typed columns are gaps."""
    valid, invalid = split_valid(typed_customers(spark, sf), ("score", "days_since_released"))
    part = lambda df, ok: df.select(F.col("bundle_id").cast("bigint").alias("custkey"), F.lit(ok).alias("ok"))
    return part(valid, True).union(part(invalid, False))


@query(
    """SELECT CAST(c_custkey AS STRING) AS bundle_id, CAST(c_custkey % 3 = 1 AS INTEGER) AS is_free_app,
    CAST(c_custkey % 3 = 0 AS INTEGER) AS is_paid_app, CAST(c_custkey % 2 = 0 AS INTEGER) AS offers_iap_flag,
    CAST(c_custkey % 2 = 1 AS INTEGER) AS no_iap_flag FROM customer"""
)
def pricing_of_typed_columns(spark, sf):
    """1.0 and TRUE both read as yes."""
    return af.pricing_features(typed_customers(spark, sf))


@query(
    f"""SELECT key, CASE WHEN k % 5 = 0 THEN score ELSE own END AS score, ratings_count, CASE WHEN k % 7 = 0
    THEN days_since_released ELSE CAST(k AS STRING) END AS days_since_released FROM ({o.imputed(
    "(SELECT CAST(c_custkey AS DOUBLE) AS key, c_custkey AS k, " + o.number_text("c_acctbal") + " AS own, "
    "CAST(CAST(c_custkey AS DOUBLE) AS STRING) AS md5_key, '' AS score, '' AS ratings_count, "
    "'' AS days_since_released, '' AS installs, '' AS real_installs, '' AS min_installs FROM customer)", "md5_key")})"""
)
def impute_typed_metrics(spark, sf):
    """NaN of a typed column is filled; the column is text afterwards."""
    filled = impute_listing_metrics(typed_customers(spark, sf))
    return filled.select(F.col("bundle_id").alias("key"), "score", "ratings_count", "days_since_released")


# --- joins of feature frames -----------------------------------------------
CUSTOMER_FLAGS = o.aliased(o.binned("c_acctbal", BALANCE, "balance_missing", (5000, 1000, 0)))
ORDER_FLAGS = o.aliased(
    o.binned("o_totalprice", ("order_big", "order_small"), "order_missing", (100000,))
)


@query(
    f"""SELECT c.c_custkey AS custkey, c_name, f.* EXCLUDE (custkey), g.* EXCLUDE (custkey) FROM customer c
    LEFT JOIN (SELECT c_custkey AS custkey, {CUSTOMER_FLAGS} FROM customer) f ON f.custkey = c.c_custkey
    LEFT JOIN (SELECT o_custkey AS custkey, {ORDER_FLAGS} FROM orders) g ON g.custkey = c.c_custkey"""
)
def attach_feature_frames(spark, sf):
    """Customers with their own flags and those of their orders: one row per order."""
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    high, mid, low, negative = BALANCE
    balance = Bins(
        (Bin(high, 5000), Bin(mid, 1000, 5000), Bin(low, 0, 1000), Bin(negative, None, 0)),
        missing="balance_missing",
    )
    size = Bins((Bin("order_big", 100000), Bin("order_small", None, 100000)), "order_missing")

    def flags(df, key, column, spec):
        made = bin_flags(F.col(column), spec)
        return df.select(F.col(key).alias("custkey"), *[c.alias(n) for n, c in made.items()])

    base = customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    parts = [
        flags(customer, "c_custkey", "c_acctbal", balance),
        flags(orders, "o_custkey", "o_totalprice", size),
    ]
    return attach_features(base, parts, "custkey")


# --- shaping ---------------------------------------------------------------
@query(
    "SELECT CAST(o_orderkey AS STRING) AS bundle_id, o_orderstatus AS status, o_orderpriority AS summary "
    "FROM orders"
)
def normalised_columns(spark, sf):
    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("Pub_Bundle"),
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_orderpriority").alias("Summary"),
    )
    return normalise_columns(raw)


@query(
    "SELECT bundle_id, description, summary, genreid, '' AS content_rating, score, '' AS ratings_count, "
    "installs, '' AS developerid, '' AS developer, '' AS free, '' AS offers_iap, days_since_released, "
    f"{o.derived_months()} AS months_since_launch FROM app_records"
)
def passthrough_columns(spark, sf):
    some = app_records(spark, sf).select(
        "bundle_id", "description", "summary", "genreid", "score", "installs", "days_since_released"
    )
    return passthrough(some, derived_months(some))


@query(
    "SELECT bundle_id, "
    + ", ".join(f"CAST(NULL AS STRING) AS {c}" for c in o.REQUIRED[1:])
    + ", CAST(NULL AS BIGINT) AS months_since_launch, "
    + ", ".join(f"CAST(NULL AS INTEGER) AS {c}" for c in o.category_flags())
    + f", {o.aliased(o.score_flags())}, "
    + ", ".join(
        f"CAST(NULL AS INTEGER) AS {c}"
        for c in (
            *o.install_flags(), *o.age_flags("NULL"), *o.pricing_flags(), *o.rating_flags()
        )
    )
    + " FROM app_records"
)
def final_columns_in_order(spark, sf):
    features = af.score_features(app_records(spark, sf))
    return final_select(features, final_columns(af.default_rules().categories))


# --- whole flows -----------------------------------------------------------
@query("SELECT * FROM enriched")
def enrich_all(spark, sf):
    return enrich_listings(app_records(spark, sf)).valid


@query(o.enriched("resolved_hydrated"))
def enrich_with_supplement(spark, sf):
    return enrich_listings(app_records(spark, sf), supplement(spark, sf)).valid


MONTHS_OF_VALID = (
    f"CASE WHEN (SELECT count({o.num('months_since_launch')}) FROM months_valid) > 0 "
    f"THEN {o.num('months_since_launch')} ELSE {o.derived_months()} END"
)


@query(o.enriched("resolved_months", MONTHS_OF_VALID))
def enrich_with_given_months(spark, sf):
    return enrich_listings(app_records_with_months(spark, sf)).valid


@query(o.enriched("ids_resolved", min_installs=False))
def enrich_ids_only(spark, sf):
    ids = table(spark, sf, "orders").selectExpr("'app.' || CAST(o_orderkey AS STRING) AS app")
    return enrich_listings(ids, supplement(spark, sf)).valid


@query("SELECT * FROM key_rows")
def rows_of_wanted_keys(spark, sf):
    return rows_or_supplement(app_records(spark, sf), key_table(spark, sf), supplement(spark, sf))


@query(o.enriched("keys_resolved"))
def enrich_wanted_keys(spark, sf):
    return enrich_keys(app_records(spark, sf), key_table(spark, sf), supplement(spark, sf)).valid


@query(
    "SELECT * FROM (WITH flags AS MATERIALIZED (SELECT * FROM enriched) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST(coalesce(sum({c}), 0) AS BIGINT) AS n, "
        f"{o.percent(f'coalesce(sum({c}), 0)', 'count(*)')} AS pct FROM flags"
        for c in o.final_flags("NULL")
    )
    + ")"
)
def coverage_report(spark, sf):
    return enrich_listings(app_records(spark, sf)).coverage_report()


@query(
    "SELECT "
    + " + ".join(f"CAST(sum({c}) AS BIGINT)" for c in o.category_flags())
    + " AS flags_set, count(*) AS rows FROM enriched"
)
def category_flag_sums(spark, sf):
    valid = enrich_listings(app_records(spark, sf)).valid
    row_sum = reduce(add, [F.col(c) for c in af.default_rules().categories])
    return valid.agg(
        F.sum(row_sum).cast("bigint").alias("flags_set"), F.count(F.lit(1)).alias("rows")
    )
