import pytest
from pyspark.sql import functions as F

import appfacet as af
from appfacet.operators.installs import install_resolution_counts
from appfacet.operators.lookup import hydration_counts
from appfacet.plans import jobs
from appfacet.plans.enrich import check_listings, enrich_listings, result_of_marked
from appfacet.sources import publish
from appfacet.streaming import reports as stream_reports
from appfacet.streaming.listings import read_stream


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def listed(table, listing):
    return table(
        [
            listing("a", months_since_launch="3"),
            listing("b", summary="", real_installs="5", months_since_launch="x"),
            listing("c", developer=None),
            listing("d", genreid="nothing", summary="none", description="plain"),
            listing(" ", score=""),
            listing("e", installs="", real_installs="77"),
        ]
    )


@pytest.fixture
def source(table, listing):
    return table([listing(k, summary=f"of {k}", real_installs="9") for k in ("b", "e", "x")])


def counted(df):
    return df.first().asDict()


@pytest.mark.parametrize("staged", [True, False])
def test_job_report_counts_every_step(spark, listed, source, tmp_path, staged):
    listed.write.parquet(f"{tmp_path}/in")
    folder = f"{tmp_path}/staging" if staged else None
    supplement = source if staged else None
    report = jobs.run_enrichment(
        spark, f"{tmp_path}/in", f"{tmp_path}/valid", f"{tmp_path}/invalid", supplement=supplement,
        input_format="parquet", output_format="parquet", staging=folder,
    )
    result = enrich_listings(listed, supplement)
    assert report.hydration == (counted(hydration_counts(listed, source)) if staged else {})
    assert report.resolution == counted(install_resolution_counts(af.hydrate(listed, supplement)))
    assigned = result.category_assignment().first()
    assert report.assignment == {"assigned": assigned["assigned"], "unassigned": assigned["unassigned"]}
    assert (report.total, report.invalid) == (6, result.invalid.count())
    assert rows_of(spark.read.parquet(f"{tmp_path}/valid")) == rows_of(result.valid)
    if staged:
        assert not [p for p in (tmp_path / "staging").glob("listings-*")]


def test_months_are_decided_by_the_staging_write(spark, listed, source, tmp_path):
    marked = check_listings(listed, source)
    rows, given = jobs.staged(marked, f"{tmp_path}/one")
    assert given is True
    staged = result_of_marked(rows, months_given=given)
    assert rows_of(staged.valid) == rows_of(enrich_listings(listed, source).valid)
    plan = staged.valid._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Subquery" not in plan
    none = check_listings(listed.withColumn("months_since_launch", F.lit("x")), source)
    rows, given = jobs.staged(none, f"{tmp_path}/two")
    assert given is False
    assert rows_of(result_of_marked(rows, months_given=given).valid) == rows_of(enrich_listings(listed.withColumn("months_since_launch", F.lit("x")), source).valid)
    assert jobs.staged(check_listings(listed.drop("months_since_launch")), f"{tmp_path}/three")[1] is None


def test_a_run_that_dies_between_its_outputs_publishes_nothing(spark, listed, source, tmp_path, monkeypatch):
    listed.write.parquet(f"{tmp_path}/in")
    valid, invalid = f"{tmp_path}/valid", f"{tmp_path}/invalid"

    def run():
        return jobs.run_enrichment(
            spark, f"{tmp_path}/in", valid, invalid, supplement=source, input_format="parquet",
            output_format="parquet", staging=f"{tmp_path}/staging", publishing=True,
        )

    first = run()
    want = rows_of(publish.read_published(spark, valid, "valid"))
    write = jobs.writer

    def dying(df, format, mode):
        if any(c in df.columns for c in ("score_45plus",)):
            raise RuntimeError("killed")
        return write(df, format, mode)

    monkeypatch.setattr(jobs, "writer", dying)
    with pytest.raises(RuntimeError, match="killed"):
        run()
    assert publish.published(spark, valid)["run"] == first.run
    assert rows_of(publish.read_published(spark, valid, "valid")) == want
    monkeypatch.setattr(jobs, "writer", write)
    second = run()
    assert second.run > first.run and publish.published(spark, valid)["report"]["valid"] == first.valid
    assert rows_of(publish.read_published(spark, valid, "valid")) == want
    assert publish.read_published(spark, valid, "invalid").count() == first.invalid
    assert not [*(tmp_path / "staging").glob("listings-*")]
    gone = publish.remove_older_runs(spark, valid)
    assert first.run in gone and len(gone) == 2 and rows_of(publish.read_published(spark, valid, "valid")) == want
    assert sorted(p.name for p in (tmp_path / "invalid").glob("run-*")) == [second.run]


def test_incomplete_manifests_and_local_staging(spark, listed, source, tmp_path, monkeypatch):
    assert publish.published(spark, f"{tmp_path}/none") is None
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, f"{tmp_path}/none", "valid")
    publish.publish(spark, f"{tmp_path}/x", "run-1", {"format": "parquet"})
    (tmp_path / "x" / "_manifests" / "run-2.json").write_text('{"run": "ru')
    assert publish.published(spark, f"{tmp_path}/x")["run"] == "run-1"

    class Cluster:
        master = "spark://somewhere:7077"

    class Session:
        sparkContext, _jvm, _jsc = Cluster, spark._jvm, spark._jsc

    with pytest.raises(ValueError, match="share"):
        jobs.staging_folder(Session, source, f"{tmp_path}/here", "out")


def batches_of(spark, listed, source, tmp_path):
    listed.write.parquet(f"{tmp_path}/all")
    stream = read_stream(spark, f"{tmp_path}/stream", listed.schema)
    return stream_reports.enrich_stream_with_reports(
        stream, f"{tmp_path}/out", f"{tmp_path}/reports", f"{tmp_path}/checkpoint", source
    )


def test_stream_reports_count_a_repeated_batch_once(spark, listed, source, tmp_path):
    listed.filter("bundle_id <= 'b'").write.parquet(f"{tmp_path}/stream")
    batches_of(spark, listed, source, tmp_path).awaitTermination()
    listed.filter("bundle_id > 'b'").write.mode("append").parquet(f"{tmp_path}/stream")
    again = stream_reports.enrich_stream_with_reports(
        read_stream(spark, f"{tmp_path}/stream", listed.schema), f"{tmp_path}/out", f"{tmp_path}/reports", f"{tmp_path}/checkpoint", source
    )
    again.awaitTermination()

    def check():
        result = enrich_listings(listed, source, months_policy="row")
        counts = stream_reports.read_counts(spark, f"{tmp_path}/reports")
        assert rows_of(stream_reports.stream_totals(counts)) == rows_of(result.validation_totals())
        assert rows_of(stream_reports.stream_empty_cells(counts)) == rows_of(result.validation_report())
        assert rows_of(stream_reports.stream_coverage(counts)) == rows_of(result.coverage_report())
        assert rows_of(stream_reports.stream_phases(counts)) == rows_of(result.phase_breakdown())
        assert rows_of(spark.read.parquet(f"{tmp_path}/out").drop("batch")) == rows_of(result.valid)

    check()
    # a restart runs the last batch once more
    stream_reports.batch_writer(f"{tmp_path}/out", f"{tmp_path}/reports", source)(listed.filter("bundle_id > 'b'"), 1)
    check()
