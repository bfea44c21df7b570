"""Reports on streams: counts of each batch, kept apart by its number and added up when read.

A streaming query may run a batch again after a restart. Each batch therefore writes its rows
and its counts to folders that its number names, and writes them over: a repeated batch counts
once. All counts are sums, so that the reports of any set of batches are those of their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.reports import percent, total_of
from ..plans.enrich import EnrichResult, enrich_listings
from ..schema import REQUIRED_COLUMNS
from ..sources.rules import CategoryRules, default_rules

COUNT_SCHEMA = "report string, item string, field string, n bigint, batch bigint"


def _long(wide: DataFrame, report: str, item: str, fields: Iterable[str]) -> DataFrame:
    """(report, item, field, n) of a table of counts."""
    cells = [F.struct(F.lit(f).alias("field"), F.col(f).cast("bigint").alias("n")) for f in fields]
    named = wide.withColumn("__item", F.col(item) if item in wide.columns else F.lit(item))
    return named.select(
        F.lit(report).alias("report"), F.col("__item").alias("item"), F.inline(F.array(*cells))
    )


def batch_counts(result: EnrichResult) -> DataFrame:
    """The counts behind all reports of an enrichment, as (report, item, field, n)."""
    return (
        _long(result.validation_totals(), "totals", "rows", ["total", "invalid"])
        .union(_long(result.validation_report(), "empty", "column", ["n"]))
        .union(_long(result.coverage_report(), "coverage", "feature", ["n"]))
        .union(_long(result.phase_breakdown(), "phases", "category", ["p1", "p2a", "p2b", "multi", "none"]))
        .union(_long(result.category_assignment(), "assignment", "rows", ["assigned", "unassigned"]))
    )


def batch_writer(
    output: str,
    reports: str,
    supplement: DataFrame | None = None,
    rules: CategoryRules | None = None,
    format: str = "parquet",
) -> Callable[[DataFrame, int], None]:
    """What a streaming query does with a batch; doing it again changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        result = enrich_listings(batch, supplement, rules=rules, months_policy="row")
        marked = result.marked.persist()  # several reports read it; a lost part is made again
        try:
            result = EnrichResult(marked, result.rules, "row")
            result.valid.write.format(format).mode("overwrite").save(f"{output}/batch={number}")
            counts = batch_counts(result).coalesce(1)
            counts.write.mode("overwrite").parquet(f"{reports}/batch={number}")
        finally:
            marked.unpersist()

    return write


def enrich_stream_with_reports(
    listings: DataFrame,
    output: str,
    reports: str,
    checkpoint: str,
    supplement: DataFrame | None = None,
    *,
    rules: CategoryRules | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Enrich a stream of listings into ``output`` and count it into ``reports``."""
    write = batch_writer(output, reports, supplement, rules)
    out = listings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()


def read_counts(spark: SparkSession, reports: str) -> DataFrame:
    """(report, item, field, n) over all batches so far."""
    batches = spark.read.schema(COUNT_SCHEMA).parquet(reports)
    return batches.groupBy("report", "item", "field").agg(F.sum("n").alias("n"))


def _of(counts: DataFrame, report: str, item: str, fields: Iterable[str]) -> DataFrame:
    """One row per item with a column per field."""
    cells = [F.coalesce(F.sum(F.when(F.col("field") == f, F.col("n"))), F.lit(0)).alias(f) for f in fields]
    return counts.where(F.col("report") == report).groupBy(F.col("item").alias(item)).agg(*cells)


def stream_totals(counts: DataFrame) -> DataFrame:
    """As ``validation_totals``; zeros before the first batch."""
    cell = lambda f: total_of(F.when((F.col("report") == "totals") & (F.col("field") == f), F.col("n")))
    sums = counts.agg(cell("total").alias("total"), cell("invalid").alias("invalid"))
    valid = F.col("total") - F.col("invalid")
    return sums.select(
        "total",
        "invalid",
        percent(F.col("invalid"), F.col("total")).alias("invalid_pct"),
        valid.alias("valid"),
        percent(valid, F.col("total")).alias("valid_pct"),
    )


def stream_empty_cells(counts: DataFrame) -> DataFrame:
    """As ``validation_report``."""
    found = _of(counts, "empty", "column", ["n"])
    return found.where((F.col("n") > 0) & F.col("column").isin(list(REQUIRED_COLUMNS)))


def stream_coverage(counts: DataFrame) -> DataFrame:
    """As ``coverage_report``."""
    valid = stream_totals(counts).select("valid")
    return _of(counts, "coverage", "feature", ["n"]).select(
        "feature", "n", percent(F.col("n"), valid.scalar()).alias("pct")
    )


def stream_phases(counts: DataFrame, rules: CategoryRules | None = None) -> DataFrame:
    """As ``phase_breakdown``."""
    known = (rules or default_rules()).categories
    found = _of(counts, "phases", "category", ["p1", "p2a", "p2b", "multi", "none"])
    return found.where(F.col("category").isin(list(known)))
