import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import appfacet as af
from appfacet.functions.terms import TermIndex, term_literal
from appfacet.operators.reduce import keep_likely
from appfacet.operators.tagging import table_category_flags, with_table_categories
from appfacet.sources.rules import Rule

WORDS = ["the", "of", "online", "shop", "shopping", "fifa", "fifa22", "cash", "a", "x" * 40, "naïve", "日本", "ab\ncd", "", "É"]
RULES = [
    ("shop", "word", "shop"), ("shop", "substring", "online shopping"), ("game", "substring", "fifa"),
    ("game", "substring", "of the online"), ("all", "word", "the"), ("all", "substring", "e"), ("two", "substring", "a c"),
    ("two", "word", "cash a"), ("odd", "substring", "ïve"), ("odd", "substring", "本"), ("odd", "word", "É"), ("odd", "substring", "b\nc"),
    ("none", "word", "absent"), ("none", "substring", "shop  cash"), ("shop", "word", "shop"), ("more", "word", "shop"),
    ("wide", "substring", "x" * 38), ("wide", "substring", "p fifa o"),
]
SCHEMA = "category string, mode string, term string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def texts(n, seed):
    rng = random.Random(seed)
    out = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 12))) for _ in range(n)]
    return [*out, None, "", "   ", "\tSHOP ", " the ", "Online  Shopping", out[0], out[0]]


def plain(text, rules=RULES):
    from appfacet.functions.text import WHITESPACE

    if text is None:
        return []
    padded = f" {text.lower().strip(WHITESPACE)} "
    return sorted({c for c, mode, term in rules if term_literal(term, mode) in padded})


@pytest.mark.parametrize("hot_rows", [None, 3])
def test_rule_table_tags_equal_every_rule_on_every_text(spark, hot_rows):
    rows = [*enumerate(texts(120, 1))]
    df = spark.createDataFrame(rows, "id int, text string").repartition(4)
    rules = spark.createDataFrame(RULES, SCHEMA)
    tagged = af.tag_with_rule_table(df, "text", rules, hot_rows=hot_rows)
    assert tagged.columns == ["id", "text", "labels"]
    assert sorted((r["id"], r["labels"]) for r in tagged.collect()) == sorted((i, plain(t)) for i, t in rows)


def test_rule_table_tags_equal_the_literal_form(spark, table):
    rules = af.default_rules()
    terms = [r.term for r in rules.rules if r.phase == "description"]
    rng = random.Random(4)
    rows = [{"id": str(i), "text": " ".join(rng.choice(terms) for _ in range(3)).upper()} for i in range(60)]
    frame = rules.to_frame(spark).where("phase = 'description'")
    tagged = af.tag_with_rule_table(table(rows), "text", frame).withColumn("own", F.array_sort(rules.description_index.tag("text")))
    found = tagged.select("labels", "own").collect()
    assert all(r["labels"] == r["own"] for r in found) and any(len(r["own"]) > 2 for r in found)


def test_empty_rules_and_empty_texts(spark):
    rules, df = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "the shop")], "id int, text string")
    assert [r["labels"] for r in af.tag_with_rule_table(df, "text", rules).collect()] == [[]]
    full = spark.createDataFrame(RULES, SCHEMA)
    assert af.tag_with_rule_table(df.where("false"), "text", full).collect() == []


@pytest.mark.parametrize("rule", [("c", "word", "  "), ("c", "substring", None), ("c", "exact", "x"), ("c", None, "x")])
def test_wrong_rules_fail(spark, rule):
    df = spark.createDataFrame([(1, "the shop")], "id int, text string")
    with pytest.raises((PySparkException, Exception), match="term"):
        af.tag_with_rule_table(df, "text", spark.createDataFrame([rule], SCHEMA)).collect()


def test_only_the_bitmap_is_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(1, "the shop")], "id int, text string")
        text = plan(af.tag_with_rule_table(df, "text", spark.createDataFrame(RULES, SCHEMA)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text
    joins = [line for line in text.splitlines() if "BroadcastHashJoin" in line]
    assert joins and all("__word" in line for line in joins)


def test_genre_table_keeps_every_row(spark, table):
    rows = [{"genreid": g} for g in (" tools ", "TOOLS", "sports", "x", "", None, "both")]
    mapping = spark.createDataFrame(
        [("TOOLS", "utility"), ("BOTH", "b"), ("BOTH", "a"), ("BOTH", "a"), ("SPORTS", "sports"), (None, "n"), ("X", None)],
        "genre string, category string",
    )
    for hot_rows in (None, 1):
        tagged = af.genre_table_categories(table(rows), mapping, hot_rows=hot_rows)
        found = sorted((r["genreid"] or "", r["categories"]) for r in tagged.collect())
        assert found == sorted([(" tools ", ["utility"]), ("TOOLS", ["utility"]), ("sports", ["sports"]), ("x", []), ("", []), ("", []), ("both", ["a", "b"])])
    empty = af.genre_table_categories(table(rows), mapping.where("false"))
    assert [r["categories"] for r in empty.collect()] == [[]] * 7


def test_table_categories_equal_literal_ones(spark, table, listing):
    rules = af.CategoryRules.from_rules(
        [Rule("a", "genre", "exact", "TOOLS"), Rule("b", "genre", "exact", "TOOLS"), Rule("a", "summary", "word", "app"), Rule("c", "description", "substring", "plain t")]
    )
    rows = [listing("1"), listing("2", genreid=None, description="PLAIN text"), listing("3", genreid="x", summary="apps", description="")]
    df = table(rows)
    own = {r["bundle_id"]: sorted(r["categories"]) for r in af.with_categories(df, rules).collect()}
    tagged = with_table_categories(df, rules.to_frame(spark))
    assert {r["bundle_id"]: r["categories"] for r in tagged.collect()} == own
    flags = tagged.select("bundle_id", *[c.alias(n) for n, c in table_category_flags("abc").items()])
    assert {r["bundle_id"]: (r["a"], r["b"], r["c"]) for r in flags.collect()} == {k: tuple(int(c in v) for c in "abc") for k, v in own.items()}
    some = with_table_categories(df.select("bundle_id", "genreid"), rules.to_frame(spark))
    assert {r["bundle_id"]: r["categories"] for r in some.collect()} == {"1": ["a", "b"], "2": [], "3": []}


def test_bitmap_keeps_every_wanted_row_and_moves_none(spark):
    df = spark.range(20000).selectExpr("IF(id % 100 = 7, NULL, concat('k', id)) AS k", "id")
    wanted = spark.range(0, 20000, 40).selectExpr("concat('k', id) AS w")
    kept = keep_likely(df, F.col("k"), wanted)
    exact = df.join(wanted, F.col("k") == F.col("w"), "left_semi")
    assert exact.exceptAll(kept).count() == 0 and kept.count() < 550
    assert keep_likely(df, F.col("k"), wanted, bits=8).count() > 10000  # full, and still right
    assert keep_likely(df, F.col("k"), wanted.where("false")).count() == 0
    assert plan(kept.select("id")).split("BroadcastExchange")[0].count("Exchange") == 0


def test_only_asked_pieces_of_tokens_move(spark):
    df = spark.createDataFrame([(i, f"tok{i}en online{i % 3} {'ab' * i} tion") for i in range(60)], "id int, text string").repartition(4)
    rules = spark.createDataFrame([("c", "substring", "lin"), ("d", "substring", "bab"), ("d", "substring", "n"), ("e", "substring", "x on")], SCHEMA)
    tagged = af.tag_with_rule_table(df, "text", rules)
    text = plan(tagged)
    # pieces pass a bitmap where they are cut, and no lambda cuts them
    cut = [line for line in text.splitlines() if "Generate explode(sequence" in line]
    assert cut and "split(__token" not in text and "lambda i" not in text
    want = {i: sorted({c for c, t in (("c", "lin"), ("d", "bab"), ("d", "n"), ("e", "x on")) if t in f" tok{i}en online{i % 3} {'ab' * i} tion "}) for i in range(60)}
    assert {r["id"]: r["labels"] for r in tagged.collect()} == want


def test_a_token_of_many_terms_is_met_once_per_text(spark):
    from appfacet.operators.tagging import _anchors, _literals

    rules = spark.createDataFrame([("c", "word", "online"), ("d", "substring", "online"), ("e", "substring", "lin"), ("f", "substring", "nl")], SCHEMA)
    vocabulary = spark.createDataFrame([("online", 9), ("offline", 2), ("nlnl", 1)], "__token string, texts long")
    met = {r["__token"]: sorted((t["literal"], t["categories"]) for t in r["__terms"]) for r in _anchors(_literals(rules), vocabulary).collect()}
    assert met == {
        "online": [(" online ", ["c"]), ("lin", ["e"]), ("nl", ["f"]), ("online", ["d"])],
        "offline": [("lin", ["e"])],
        "nlnl": [("nl", ["f"])],
    }


def test_bitmap_has_room_for_millions_of_keys(spark):
    df = spark.range(200000).selectExpr("concat('other', id) AS k")
    wanted = spark.range(2000000).selectExpr("concat('k', id) AS w")
    assert keep_likely(df, F.col("k"), wanted).count() < 10000
    assert keep_likely(wanted, F.col("w"), wanted).count() == 2000000
