import pytest
from pyspark.sql import functions as F

import appfacet as af
from appfacet.operators import reports
from appfacet.operators.columns import as_text, find_column, normalise_columns
from appfacet.operators.facets import all_features
from appfacet.schema import AGE_BINS, INSTALL_BINS, RATING_VALUES, SCORE_BINS, final_columns
from appfacet.sources.rules import CategoryRules, Rule


def hot(df, names):
    """Per key the names of the flags that are 1."""
    return {r["bundle_id"]: [n for n in names if r[n] == 1] for r in df.collect()}


def by_value(table, column, cells, build, names):
    rows = table([{"bundle_id": str(i), column: c} for i, c in enumerate(cells)], ["bundle_id", column])
    found = hot(build(rows), names)
    return [found[str(i)] for i in range(len(cells))]


def test_score_bins(table):
    cells = ["4.5", "4.0", "3.0", "2.99", "nan", "abc", "1d", None]
    found = by_value(table, "score", cells, af.score_features, SCORE_BINS.names)
    expected = ["score_45plus", "score_40_45", "score_30_40", "score_below30"] + ["score_missing"] * 4
    assert found == [[e] for e in expected]


def test_install_bins(table):
    cells = ["10,000,000+", "9,999,999", "1 000 000+", "100000", "99,999+", "0", "-5", "Varies"]
    found = by_value(table, "installs", cells, af.install_features, INSTALL_BINS.names)
    big, mid, small, low = INSTALL_BINS.names[:4]
    assert found == [[x] for x in (big, mid, mid, small, low, low, low, "installs_missing")]
    row = table([{"bundle_id": "a", "installs": "Varies", "min_installs": "1000000"}])
    assert hot(af.install_features(row), INSTALL_BINS.names) == {"a": [mid]}


def test_age_bins_and_policies(table):
    cells = ["3", "3.5", "12", "13", "24", "25", None]
    young, year, two, old, missing = AGE_BINS.names
    found = by_value(table, "months_since_launch", cells, af.age_features, AGE_BINS.names)
    assert found == [[x] for x in (young, year, year, two, two, old, missing)]
    rows = table(
        [
            {"bundle_id": "a", "months_since_launch": "30", "days_since_released": "10"},
            {"bundle_id": "b", "months_since_launch": " ", "days_since_released": "200"},
        ]
    )
    assert hot(af.age_features(rows, "dataset"), AGE_BINS.names) == {"a": [old], "b": [missing]}
    assert hot(af.age_features(rows, "row"), AGE_BINS.names) == {"a": [old], "b": [year]}
    none_given = rows.withColumn("months_since_launch", F.lit("n"))
    assert hot(af.age_features(none_given), AGE_BINS.names) == {"a": [young], "b": [year]}
    assert hot(af.age_features(rows.select("bundle_id")), AGE_BINS.names) == {"a": [missing], "b": [missing]}
    with pytest.raises(ValueError):
        af.age_features(rows, "other")


def test_pricing(table):
    rows = table(
        [
            {"bundle_id": "a", "free": " yes ", "Offers_IAP": "0"},
            {"bundle_id": "b", "free": "maybe", "Offers_IAP": None},
        ]
    )
    names = ["is_free_app", "is_paid_app", "offers_iap_flag", "no_iap_flag"]
    assert hot(af.pricing_features(rows), names) == {"a": ["is_free_app", "no_iap_flag"], "b": []}
    without = rows.drop("Offers_IAP")
    assert hot(af.pricing_features(without), names) == {"a": ["is_free_app"], "b": []}


def test_ratings(table):
    known = [(name, v) for name, vs in RATING_VALUES.items() for v in vs]
    cells = [f"  {v.title()} " for _, v in known] + ["Unrated", "", None]
    names = [*RATING_VALUES, "rating_missing", "rating_other"]
    found = by_value(table, "content_rating", cells, af.rating_features, names)
    assert len(known) == 15
    assert found == [[n] for n, _ in known] + [["rating_other"], ["rating_missing"], ["rating_missing"]]


def test_default_rules_have_the_stated_size():
    rules = af.default_rules()
    assert (len(rules.categories), len(rules.genres)) == (26, 49)
    sizes = [sum(r.phase == p for r in rules.rules) for p in ("genre", "summary", "description")]
    assert sizes == [55, 260, 290]
    assert sum(r.mode == "word" for r in rules.rules) == 158


def test_genres(table):
    cells = [" game_word ", "SPORTS", "NOPE", "", None]
    rows = table([{"i": str(i), "g": c} for i, c in enumerate(cells)], ["i", "g"])
    found = {r[0]: r[1] for r in rows.select("i", af.genre_categories("g")).collect()}
    assert found["0"] == ["is_word_game"]
    assert set(found["1"]) == {"is_entertainment", "is_sports_game"}
    assert found["2"] == found["3"] == found["4"] == []


def test_text_phases(table):
    cells = ["invest", "invest,", "fifa22", "fifa", "market", "stock\nmarket", "A Stock Marketer"]
    rows = table([{"i": str(i), "t": c} for i, c in enumerate(cells)])
    both = rows.select("i", af.summary_categories("t"), af.description_categories("t")).collect()
    found = {r[0]: (r[1], r[2]) for r in both}
    assert found["0"] == (["is_investments"], [])
    assert found["1"] == ([], [])
    assert found["2"] == ([], ["is_sports_game"])
    assert found["3"] == (["is_sports_game"], ["is_sports_game"])
    assert found["4"] == found["5"] == ([], [])
    assert found["6"] == (["is_investments"], ["is_investments"])


def test_custom_rules_and_union(table, spark):
    rules = CategoryRules.from_rules(
        [
            Rule("x", "genre", "exact", "G"),
            Rule("y", "summary", "word", "tap"),
            Rule("z", "description", "substring", "tap to"),
        ]
    )
    again = af.rules_from_frame(rules.to_frame(spark), ["x", "y", "z"])
    rows = table([{"bundle_id": "a", "genreId": " g", "summary": "tap", "description": "Tap tool"}])
    assert hot(af.category_features(rows, again), ["x", "y", "z"]) == {"a": ["x", "y", "z"]}
    assert set(af.with_categories(rows, rules).first()["categories"]) == {"x", "y", "z"}
    assert hot(af.category_features(rows.select("bundle_id"), rules), ["x", "y", "z"]) == {"a": []}
    with pytest.raises(ValueError):
        CategoryRules.from_rules([Rule("x", "title", "word", "t")])
    with pytest.raises(FileNotFoundError):
        af.rules_from_document("/tmp/no-such-document.md")


def test_one_flag_per_family(table, listing):
    rows = table([listing(str(i), score=s, installs=n, days_since_released=d, content_rating=r)
                  for i, (s, n, d, r) in enumerate(zip(["4.5", "x", None, "1"], ["5+", "a", "0", None],
                                                       ["1", "b", "900", " "], ["Teen", "T", "", None]))])
    features = all_features(rows)
    for names in (SCORE_BINS.names, INSTALL_BINS.names, AGE_BINS.names,
                  [*RATING_VALUES, "rating_missing", "rating_other"]):
        total = sum((F.col(n) for n in names), F.lit(0))
        assert features.where(total != 1).count() == 0


def test_breakdown_and_assignment(table, listing):
    rows = table(
        [
            listing("a", genreid="FINANCE", summary="upi", description="bank account"),
            listing("b", genreid="NOPE", summary="upi", description="none"),
            listing("c", genreid="NOPE"),
        ]
    )
    found = {r["category"]: tuple(r)[1:] for r in reports.phase_breakdown(rows).collect()}
    assert len(found) == 26
    assert found["is_finance"] == (1, 2, 1, 1, 1)
    assert found["is_crypto"] == (0, 0, 0, 0, 3)
    assignment = af.enrich_listings(rows).category_assignment().first()
    assert (assignment["assigned"], assignment["unassigned"]) == (2, 1)


def test_names(table):
    assert normalise_columns(table([{"PUB_BUNDLE": "a", "X": "1"}])).columns == ["bundle_id", "x"]
    assert normalise_columns(table([{"Anything": "a"}])).columns == ["bundle_id"]
    assert normalise_columns(table([{"a": "1", "b": "2"}])).columns == ["a", "b"]
    with pytest.raises(ValueError):
        normalise_columns(table([{"a": "1"}]).selectExpr("a as Score", "a as score"))
    assert find_column(table([{"genreId": "x"}]), "GENREID") == "genreId"


def test_values_as_text(spark):
    df = spark.sql(
        "SELECT 1.0D a, 4.5D b, double('NaN') c, true d, false e, 12 f, cast(null as boolean) g, 25000000.0D h"
    )
    assert tuple(as_text(df).first()) == ("1", "4.5", None, "True", "False", "12", None, "25000000")


def test_final_columns():
    names = final_columns(af.default_rules().categories)
    assert len(names) == len(set(names)) == 71
    assert names[13] == "months_since_launch" and names[14] == "is_investments"


def test_the_package_reads_the_vocabulary_that_the_twins_have():
    from checks.vocabulary import categories, vocabulary

    rules = af.default_rules()
    assert [(r.category, r.phase, r.term) for r in rules.rules] == [tuple(t) for t in vocabulary()]
    assert rules.categories == categories()
