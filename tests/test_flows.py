import tempfile

import pytest
from pyspark.sql import functions as F

import appfacet as af
from appfacet.operators.columns import add_required
from appfacet.operators.impute import imputation_counts
from appfacet.operators.installs import install_resolution_counts, resolve_installs
from appfacet.operators.keys import rows_or_supplement
from appfacet.operators.lookup import hydration_counts
from appfacet.operators.spread import attach_features, hot_keys, spread_join
from appfacet.operators.validity import split_valid
from appfacet.plans.jobs import run_enrichment, run_imputation, run_keys
from appfacet.schema import REQUIRED_COLUMNS
from appfacet.streaming.listings import enrich_stream, read_stream, write_stream


def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- supplement ------------------------------------------------------------
SOURCE = """
SELECT ' app.one ' bundle_id, 'long text' description, 'short' summary, 'TOOLS' genreId,
 'Teen' contentRating, 4.5D score, 10L ratings, 0L realInstalls, '50+' installs, 'd' developerId,
 'Dev' developer, true free, false offersIAP, 'Jan 5, 2020' released
UNION ALL SELECT 'app.one', 'zzz', 'zzz', 'TOOLS', 'Teen', 1.0D, 1L, 7L, '1+', 'x', 'X', true, true, 'junk'
UNION ALL SELECT ' ', 'blank key', 's', 'TOOLS', 'Teen', 1.0D, 1L, 7L, '1+', 'x', 'X', true, true, 'junk'
UNION ALL SELECT 'app.gap', null, '  ', 'TOOLS', 'Teen', 1.0D, 1L, 7L, '1+', 'x', 'X', true, true, ''
"""


@pytest.fixture
def supplement(spark):
    return af.map_supplement(spark.sql(SOURCE), "2020-06-01")


def test_supplement_mapping(supplement):
    first = supplement.first().asDict()
    assert first["installs"] == "50+" and first["real_installs"] == "0"
    assert first["days_since_released"] == "148" and first["free"] == "True"
    assert [r["installs"] for r in supplement.collect()] == ["50+", "7", "7", "7"]
    assert [r["days_since_released"] for r in supplement.collect()][1:] == [None] * 3


@pytest.mark.parametrize("options", [{}, {"one_pass": True}, {"hot_rows": 1}, {"hot_rows": None}])
def test_hydrate(table, listing, supplement, options):
    base = table(
        [
            listing("app.one ", summary=" ", description=None),
            listing("app.one", score=""),
            listing("app.two", summary=""),
            listing(" ", summary=""),
            listing(None, summary=""),
            listing("app.gap", summary="", installs="\t"),
            listing("app.full"),
        ]
    )
    done = af.hydrate(base, supplement, **options)
    found = {(r["bundle_id"], r["score"]): r.asDict() for r in done.collect()}
    assert done.count() == base.count() == len(found)
    one = found["app.one ", "4.5"]
    assert (one["summary"], one["description"], one["developer"]) == ("short", "long text", "Dev")
    assert found["app.two", "4.5"]["summary"] == "" == found["app.gap", "4.5"]["summary"]
    assert found["app.gap", "4.5"]["installs"] == "7"
    assert found["app.full", "4.5"]["real_installs"] is None
    assert found[" ", "4.5"]["summary"] == found[None, "4.5"]["summary"] == ""
    counts = hydration_counts(base, supplement).first()
    assert (counts["targets"], counts["fetched"]) == (4, 3)


def test_mark_equals_validity(table, listing, supplement):
    base = table(
        [
            listing("app.one", summary=""),
            listing("app.two", summary=""),
            listing("", summary="x"),
            listing("app.gap", summary="", description=""),
            listing("app.four", installs="", real_installs="9"),
            listing("app.five", installs="", real_installs="0"),
            listing("app.gap", installs=""),
            listing("app.six"),
        ]
    )
    for given in (None, supplement):
        result = af.enrich_listings(base, given)
        valid, invalid = split_valid(result.checked)
        assert rows_of(result.valid_inputs) == rows_of(valid)
        assert rows_of(result.invalid) == rows_of(invalid)
        assert valid.count() + invalid.count() == base.count()
        totals = result.validation_totals().first()
        assert (totals["total"], totals["invalid"]) == (8, invalid.count())


# --- joins under skew ------------------------------------------------------
def test_spread_join_equals_plain_join(spark):
    left = spark.range(0, 4000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 40) END k", "id"
    )
    right = spark.range(60).selectExpr("concat('k', id) k", "id AS v").union(spark.sql("SELECT 'hot', -1L"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        assert rows_of(spread_join(left, right, "k", how, hot_rows=100)) == rows_of(plain)
    hot = {r[0]: r[1] for r in hot_keys(left, F.col("k"), 100).collect()}
    assert hot["hot"] == 14


def test_attach_features_fans_out(spark):
    base = spark.sql("SELECT explode(array('a', 'a', 'b', NULL)) k").withColumn("x", F.lit(1))
    one = spark.sql("SELECT explode(array('a', 'a')) k").withColumn("y", F.lit(2))
    two = spark.sql("SELECT explode(array('a', 'b', 'b')) k").withColumn("z", F.lit(3))
    plain = base.join(one, "k", "left").join(two, "k", "left")
    for hot_rows in (None, 1, 1000):
        assert rows_of(attach_features(base, [one, two], "k", hot_rows)) == rows_of(plain)
    with pytest.raises(ValueError):
        attach_features(base, [one, one], "k")


def test_join_of_families_equals_projection(table, listing):
    base = table([listing(f"app.{i}", score=str(i), genreid="SPORTS") for i in range(6)])
    families = [
        af.category_features, af.score_features, af.install_features, af.age_features,
        af.pricing_features, af.rating_features,
    ]
    joined = attach_features(base.select("bundle_id"), [f(base) for f in families], "bundle_id")
    direct = af.enrich_listings(base).valid.select(*joined.columns)
    assert rows_of(joined) == rows_of(direct)


def test_duplicate_keys_keep_rows(table, listing):
    result = af.enrich_listings(table([listing("a"), listing("a"), listing("b")]))
    assert result.valid.count() == 3


# --- installs and imputation -----------------------------------------------
def test_resolve_installs(table):
    rows = table(
        [{"bundle_id": str(i), "installs": "5+", "real_installs": r}
         for i, r in enumerate(["12", "12.9", "0", "-1", "x", None])]
    )
    assert [r["installs"] for r in resolve_installs(rows).collect()] == ["12", "12"] + ["5+"] * 4
    assert tuple(install_resolution_counts(rows).first()) == (2, 4)
    without = rows.drop("real_installs")
    assert resolve_installs(without) is without


def test_imputation(table):
    rows = table(
        [
            {"bundle_id": "a", "installs": "none", "ratings_count": "7"},
            {"bundle_id": "b", "installs": "50"},
            {"bundle_id": "c", "installs": "1000000000000"},
            {"bundle_id": "d", "installs": "0", "min_installs": "1,000+", "score": "2.2"},
        ]
    )
    done = {r["bundle_id"]: r.asDict() for r in af.impute_listing_metrics(rows).collect()}
    assert (done["a"]["ratings_count"], done["a"]["days_since_released"]) == ("7", "630")
    assert (done["b"]["ratings_count"], done["b"]["days_since_released"]) == ("1", "90")
    assert done["c"]["days_since_released"] == "1825"
    assert (done["d"]["ratings_count"], done["d"]["score"]) == ("10", "2.2")
    assert all(3.0 <= float(done[k]["score"]) <= 4.3 for k in "abc")
    again = af.impute_listing_metrics(af.impute_listing_metrics(rows))
    assert rows_of(again) == rows_of(af.impute_listing_metrics(rows))
    other = {r["bundle_id"]: r["score"] for r in af.impute_listing_metrics(rows, seed=9).collect()}
    assert any(other[k] != done[k]["score"] for k in "abc")
    assert tuple(imputation_counts(rows).first()) == (4, 10)


# --- keys ------------------------------------------------------------------
def test_keys(spark, table, listing, supplement):
    base = table([listing(" app.x "), listing("app.x", score=""), listing("app.y")])
    keys = spark.sql("SELECT explode(array('app.x', ' app.one', 'app.none', '', NULL, 'app.x')) k")
    for hot_rows in (None, 1):
        found = rows_or_supplement(base, keys, supplement, hot_rows=hot_rows)
        assert sorted(r["bundle_id"] for r in found.collect()) == [" app.x ", "app.one", "app.x"]
    result = af.enrich_keys(base, keys, supplement)
    scores = {r["bundle_id"]: r["score"] for r in result.valid.collect()}
    assert scores.keys() == {" app.x ", "app.one", "app.x"}
    assert float(scores["app.x"]) >= 3.0 and scores["app.one"] == "4.5"
    assert af.enrich_keys(base, keys).valid.count() == 2
    with pytest.raises(ValueError):
        af.enrich_keys(base.drop("bundle_id"), keys)


def test_ids_only(spark, supplement):
    result = af.enrich_listings(spark.sql("SELECT explode(array('app.one', 'app.none')) AS app"), supplement)
    assert [r["bundle_id"] for r in result.valid.collect()] == ["app.one"]
    assert [r["bundle_id"] for r in result.invalid.collect()] == ["app.none"]
    assert add_required(spark.sql("SELECT 'a' bundle_id")).columns == list(REQUIRED_COLUMNS)


# --- files -----------------------------------------------------------------
def test_csv_job(spark, table, listing, supplement):
    base, text = folder(), 'Line one\nsaid "hi", done'
    lines = [listing("a", description=text, developer="None"), listing("b", description=text),
             listing("app.one", summary=" "), listing("c", score="N/A")]
    header = ",".join(lines[0]).replace("score", "Score")
    quote = '"{}"'.format
    body = "\n".join(",".join(quote(v.replace('"', '""')) for v in r.values()) for r in lines)
    with open(f"{base}/in.csv", "w", encoding="utf-8") as out:
        out.write(f"{header}\n{body}\n")
    report = run_enrichment(spark, f"{base}/in.csv", f"{base}/out", f"{base}/bad")
    assert (report.total, report.valid, report.invalid) == (4, 1, 3)
    assert report.empty_cells == {"developer": 1, "summary": 1, "score": 1}
    assert report.coverage["installs_1m_10m"] == 1 and report.percent(report.valid) == 25.0
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    good = back.csv(f"{base}/out")
    assert len(good.columns) == 71 and good.first()["description"] == text
    assert back.csv(f"{base}/bad").count() == 3
    # The rejected rows go through the imputer and back; a supplement fills the rest.
    counts = run_imputation(spark, f"{base}/bad", f"{base}/filled")
    assert counts == {"input_rows": 3, "filled_cells": 1}
    second = run_enrichment(
        spark, f"{base}/filled", f"{base}/out2", f"{base}/bad2", supplement=supplement, output_format="parquet"
    )
    assert (second.valid, second.invalid) == (2, 1)
    assert {r["bundle_id"] for r in spark.read.parquet(f"{base}/out2").collect()} == {"c", "app.one"}
    keys = spark.sql("SELECT 'c' k")
    third = run_keys(spark, f"{base}/in.csv", keys, f"{base}/out3", f"{base}/bad3")
    assert (third.valid, third.invalid) == (1, 0)


def test_staged_job_reads_what_it_wrote(spark, table, listing):
    base = folder()
    table([listing("a"), listing("b", score="")]).write.parquet(f"{base}/in")
    report = run_enrichment(
        spark, f"{base}/in", f"{base}/out", f"{base}/bad",
        input_format="parquet", output_format="parquet", staging=f"{base}/stage",
    )
    assert (report.valid, report.invalid) == (1, 1)
    assert spark.read.parquet(f"{base}/bad").first()["bundle_id"] == "b"


# --- streams ---------------------------------------------------------------
def test_stream_gives_the_batch_rows(spark, table, listing, supplement):
    base = folder()
    rows = [listing("app.one", summary=""), listing("b"), listing("c", score="")]
    batch = table(rows)
    batch.repartition(3).write.parquet(f"{base}/in")
    stream = read_stream(spark, f"{base}/in", batch.schema)
    for number, given in enumerate((None, supplement)):
        result, expected = enrich_stream(stream, given), af.enrich_listings(batch, given)
        for name in ("valid", "invalid"):
            out = f"{base}/{name}{number}"
            write_stream(getattr(result, name), out, f"{out}-state").awaitTermination()
            written = spark.read.schema(getattr(expected, name).schema).parquet(out)
            assert rows_of(written) == rows_of(getattr(expected, name))


# --- plans -----------------------------------------------------------------
def test_features_need_no_shuffle_join_or_python(spark, table, listing):
    base = folder()
    table([listing("a")]).write.parquet(f"{base}/in")
    text = plan(af.enrich_listings(spark.read.parquet(f"{base}/in")).valid)
    for word in ("Exchange", "Join", "Python", "ArrowEval"):
        assert word not in text
    assert text.count("lower(description") == 1


def test_unused_columns_are_not_read(spark, table, listing):
    base = folder()
    table([listing("a", extra="x")]).write.parquet(f"{base}/in")
    text = plan(af.score_features(spark.read.parquet(f"{base}/in")))
    assert "ReadSchema: struct<bundle_id:string,score:string>" in text


def test_only_needy_rows_are_shuffled(spark, table, listing, supplement):
    base = folder()
    table([listing("a")]).write.parquet(f"{base}/in")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(af.hydrate(spark.read.parquet(f"{base}/in"), supplement))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "CartesianProduct" not in text and "Union" in text


# --- skew, sizes, plans ----------------------------------------------------
@pytest.mark.parametrize("hot_rows", [None, 1, 5])
def test_hot_keys_on_either_side(spark, hot_rows):
    base = spark.range(60).selectExpr("CASE WHEN id % 7 = 6 THEN NULL ELSE id % 7 END AS k", "id AS a")
    part = spark.range(90).selectExpr("CASE WHEN id < 70 THEN 2 ELSE id % 5 END AS k", "id AS b")
    other = spark.range(3).selectExpr("id AS k", "id * 2 AS c")
    plain = base.join(part, "k", "left").join(other, "k", "left")
    assert rows_of(attach_features(base, [part, other], "k", hot_rows)) == rows_of(plain)


def test_counts_beyond_bigint_are_kept(table, listing):
    rows = [listing("a", installs="", real_installs="1e19"), listing("b", real_installs="1e22"), listing("c", installs="", real_installs="0")]
    result = af.enrich_listings(table(rows))
    installs = {r["bundle_id"]: r["installs"] for r in result.valid.collect()}
    assert installs == {"a": "1" + "0" * 19, "b": "1" + "0" * 22}
    assert [r["bundle_id"] for r in result.invalid.collect()] == ["c"]
    ratings = af.impute_listing_metrics(table([listing(installs="1e22", ratings_count="")])).first()["ratings_count"]
    assert ratings == "1" + "0" * 20


def test_fullest_supplement_row_fills_and_others_complete_it(spark, table, listing):
    rows = table([{"bundle_id": "k"}, {"bundle_id": "k", "summary": "s", "developer": "d"}, {"bundle_id": "k", "score": "4.0", "summary": "zz"}])
    rows = rows.select("*", *[F.lit(None).cast("string").alias(c) for c in REQUIRED_COLUMNS if c not in rows.columns])
    got = af.hydrate(table([listing("k", summary="", developer=" ", score=None)]), rows).first()
    assert (got["summary"], got["developer"], got["score"]) == ("s", "d", "4.0")


def test_nan_of_typed_columns_is_a_gap(spark):
    df = spark.sql("SELECT 'k' bundle_id, double('NaN') score, 5L ratings_count, 1.0D free, true offers_iap")
    valid, invalid = split_valid(df, ("bundle_id", "score"))
    assert (valid.count(), invalid.count()) == (0, 1)
    filled = af.impute_listing_metrics(df).first()
    assert float(filled["score"]) >= 3.0 and filled["ratings_count"] == "5"
    assert af.pricing_features(df).first()["is_free_app"] == 1


def test_key_flow_reads_each_input_little(spark, tmp_path, table, listing):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        table([listing(f"app.{i}") for i in range(9)]).write.parquet(f"{tmp_path}/listings")
        spark.sql(SOURCE).write.parquet(f"{tmp_path}/source")
        keys = spark.sql("SELECT explode(array('app.1', 'app.one')) k")
        source = af.map_supplement(spark.read.parquet(f"{tmp_path}/source"), "2020-06-01")
        result = af.enrich_keys(spark.read.parquet(f"{tmp_path}/listings"), keys, source, months_policy="row")
        lines = [line for line in plan(result.valid).split("\n") if "FileScan" in line]
        assert sum("listings" in line for line in lines) <= 2 and sum("source" in line for line in lines) <= 2
        assert {r["bundle_id"] for r in result.valid.collect()} == {"app.1", "app.one"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shares_of(left, hot_rows):
    """Rows per key and share, as they reach a join that isn't a broadcast one."""
    from appfacet.operators import spread

    key = F.col("k")
    shared = spread.with_share(left, key, spread.hot_keys(left, key, hot_rows), hot_rows)
    return {(r["k"], r["__share"]): r["count"] for r in shared.groupBy("k", "__share").count().collect()}


def test_no_share_holds_more_than_the_hot_rows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 20000, 1, 8).selectExpr("IF(id % 10 = 0, concat('k', id % 7), 'hot') k", "id")
        right = spark.sql("SELECT 'hot' k, 1 w UNION ALL SELECT 'k3', 2 UNION ALL SELECT 'hot', 3")
        shares = shares_of(left, 2000)
        assert max(shares.values()) <= 2000 and sum(shares.values()) == 20000
        assert len([1 for k, _ in shares if k == "hot"]) > 9
        for how in ("left", "inner", "left_semi", "left_anti"):
            assert rows_of(spread_join(left, right, "k", how, 2000)) == rows_of(left.join(right, "k", how))
        alike = spark.range(0, 20000, 1, 40).selectExpr("'hot' k")  # equal rows spread by their partitions
        assert max(shares_of(alike, 4000).values()) <= 6000
        assert "SortMergeJoin" in plan(spread_join(left, right, "k", "left", 2000))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_of_empty_null_and_mixed_keys(spark):
    right = spark.range(5).selectExpr("id AS k", "id * 10 AS w")
    for left in (
        spark.range(50).selectExpr("CAST(id % 2 AS INT) k", "id"),
        spark.range(50).selectExpr("CAST(NULL AS INT) k", "id"),
        spark.range(0).selectExpr("CAST(id AS SHORT) k", "id"),
    ):
        assert rows_of(spread_join(left, right, "k", "left", 5)) == rows_of(left.join(right, "k", "left"))
    listed = spark.range(50).selectExpr("array(id % 2) k", "id", "map(id, id) m").drop("m")
    other = spark.range(5).selectExpr("array(id) k", "id AS w")
    assert rows_of(spread_join(listed, other, "k", "left", 5)) == rows_of(listed.join(other, "k", "left"))


# --- plans of the lookup ----------------------------------------------------
def nodes(node):
    """A node of a physical plan and all below it."""
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def static_plan(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unasked_supplement_texts_are_not_shuffled(spark, table, listing, tmp_path):
    table([listing("a", summary=""), listing("b")]).write.parquet(f"{tmp_path}/listed")
    table([listing(k, summary=f"of {k}") for k in "abcdef"]).write.parquet(f"{tmp_path}/source_table")
    listed, source = spark.read.parquet(f"{tmp_path}/listed"), spark.read.parquet(f"{tmp_path}/source_table")
    whole = static_plan(spark, af.hydrate(listed, source))
    moved = 0
    for node in nodes(whole):
        if node.nodeName() != "Exchange":
            continue
        below = [*nodes(node)]
        scans = [n for n in below if n.nodeName().startswith("Scan parquet")]
        if any("source_table" in n.relation().location().rootPaths().toString() for n in scans):
            moved += 1
            assert any(n.nodeName() == "BroadcastHashJoin" and "__word" in n.simpleString(10000) for n in below)
    assert moved
    assert "SortAggregate" not in {n.nodeName() for n in nodes(whole)}


def test_first_row_and_least_values_of_a_key(table, listing):
    from appfacet.operators.lookup import one_per_key

    rows = [
        listing("k", summary="", developer="z", installs=None),
        listing(" k ", summary="b", developer="", installs="7"),
        listing("k", summary="a", developer="y", installs="", score=""),
        listing("full"),
        listing("full"),
        listing("hole", summary=" "),
        listing(None),
        listing(" "),
    ]
    found = {r["__lookup_key"]: r for r in one_per_key(table(rows)).collect()}
    assert sorted(found) == ["full", "hole", "k"]
    k = found["k"]  # the fullest row is the second; what it lacks is the least of the others
    assert (k["__summary"], k["__developer"], k["__installs"], k["__score"]) == ("b", "y", "7", "4.5")
    assert found["hole"]["__summary"] is None and found["full"]["__summary"] == "An app for all"
    ordered = one_per_key(table([r | {"rank": str(i)} for i, r in enumerate(rows)]), ["rank"])
    (first,) = [r for r in ordered.collect() if r["__lookup_key"] == "k"]
    assert (first["__summary"], first["__developer"], first["__installs"]) == ("a", "z", "7")


def test_supplement_rows_are_shuffled_before_they_are_sorted(spark, table, listing, tmp_path):
    from appfacet.operators.lookup import one_per_key

    table([listing(f"k{i % 3}", summary=str(i)) for i in range(9)]).write.parquet(f"{tmp_path}/s")
    one = one_per_key(spark.read.parquet(f"{tmp_path}/s"))
    whole = [*nodes(static_plan(spark, one))]
    moved = [n for n in whole if n.nodeName() == "Exchange"]
    assert len(moved) == 2 and "Generate" not in {n.nodeName() for n in whole}
    # the lower exchange moves rows as they are read
    assert not {n.nodeName() for n in nodes(moved[-1])} & {"Sort", "Window", "WindowGroupLimit"}
    assert [(r["__lookup_key"], r["__summary"]) for r in one.orderBy("__lookup_key").collect()] == [("k0", "0"), ("k1", "1"), ("k2", "2")]


def test_rows_that_need_no_lookup_spread_in_one_pass(spark, table, listing):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        base = table([listing(f"app.{i}") for i in range(200)] + [listing(None, summary=str(i)) for i in range(200)])
        done = af.hydrate(base, table([listing("app.x")]), one_pass=True)
        held = [r["n"] for r in done.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(held) == 400 and max(held) < 200


def test_packed_rows_come_out_as_they_went_in(spark):
    from appfacet.operators.packing import repartition_packed

    rows = [(i, f"k{i % 3}", *row) for i, row in enumerate([("a", None, "", " é日𝄞 "), (None,) * 4, ("", "", "", ""), ("x" * 70_000, "y", None, "z" * 9)])]
    base = spark.createDataFrame(rows, "n long, k string, `a.b` string, b string, c string, d string").withColumn("e", F.expr("CAST(X'ff00c3' AS STRING)"))
    for keys in (["k"], ["k", "b"], ["k", "a.b", "b", "c", "d", "e"]):
        moved = repartition_packed(base, [f"`{c}`" if "." in c else c for c in keys]) if "a.b" not in keys else repartition_packed(base.withColumnRenamed("a.b", "ab"), ["k", "ab", "b", "c", "d", "e"]).withColumnRenamed("ab", "a.b")
        raw = lambda df: sorted(tuple(r) for r in df.select("n", "k", "`a.b`", "b", "c", "d", F.hex("e")).collect())
        assert raw(moved) == raw(base) and sorted(moved.columns) == sorted(base.columns)
    swapped = repartition_packed(base, ["k"], {"b": F.nullif(F.col("b"), F.col("d"))})
    assert [r["b"] for r in swapped.orderBy("n").collect()] == [None, None, None, "y"]


def test_supplement_rows_are_packed_where_they_are_shuffled(spark, table, listing):
    from appfacet.operators.lookup import one_per_key

    one = one_per_key(table([listing(f"k{i % 3}", summary=str(i), developer=None) for i in range(9)]).withColumn("ratings_count", F.lit(5)))
    moved = [n for n in nodes(static_plan(spark, one)) if n.nodeName() == "Exchange"]
    for node in moved:
        assert "__bytes" in node.output().toString() and "summary" not in node.output().toString()
    got = {r["__lookup_key"]: r for r in one.collect()}
    assert {k: (r["__summary"], r["__ratings_count"], r["__bundle_id"]) for k, r in got.items()} == {f"k{i}": (str(i), 5, f"k{i}") for i in range(3)}


def test_unwanted_listings_and_supplement_rows_are_not_shuffled(spark, table, listing, tmp_path):
    table([listing(f"k{i}") for i in range(9)]).write.parquet(f"{tmp_path}/listed")
    table([listing(f" s{i} ", summary=str(i)) for i in range(9)]).write.parquet(f"{tmp_path}/source_table")
    keys = table([{"w": "k1"}, {"w": " k1"}, {"w": "s2"}, {"w": None}, {"w": " "}, {"w": "none"}])
    got = rows_or_supplement(spark.read.parquet(f"{tmp_path}/listed"), keys, spark.read.parquet(f"{tmp_path}/source_table"))
    whole, moves = static_plan(spark, got), {"listed": 0, "source_table": 0}
    for node in nodes(whole):
        for name in moves if node.nodeName() == "Exchange" else ():
            below = [*nodes(node)]
            if any(n.nodeName().startswith("Scan parquet") and name in n.relation().location().rootPaths().toString() for n in below):
                moves[name] += 1
                assert any(n.nodeName() == "BroadcastHashJoin" and "__word" in n.simpleString(10000) for n in below)
    assert all(moves.values()) and moves["source_table"] == 2
    assert sorted((r["bundle_id"], r["summary"]) for r in got.collect()) == [("k1", "An app for all"), ("s2", "2")]
