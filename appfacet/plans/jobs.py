"""Jobs from paths to paths; the reports ride on the writes as observed metrics."""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.numbers import safe_double
from ..functions.text import is_empty
from ..operators.columns import add_missing
from ..operators.facets import MONTHS
from ..operators.impute import impute_listing_metrics
from ..operators.lookup import VALID
from ..operators.reports import total_of
from ..schema import FILLABLE_COLUMNS, REQUIRED_COLUMNS
from ..sources.publish import is_local, new_run, publish, remove_folder
from ..sources.rules import CategoryRules
from ..sources.tables import (
    read_for_imputation,
    read_listings,
    with_partitions,
    writer,
)
from .enrich import EnrichResult, check_listings, enrich_keys, result_of_marked


@dataclass(frozen=True)
class JobReport:
    """Counts gathered while the outputs were written.

    ``hydration`` is empty without a supplement. ``run`` names the run that was published.
    """

    valid: int
    invalid: int
    empty_cells: dict[str, int] = field(default_factory=dict)
    coverage: dict[str, int] = field(default_factory=dict)
    hydration: dict[str, int] = field(default_factory=dict)
    resolution: dict[str, int] = field(default_factory=dict)
    assignment: dict[str, int] = field(default_factory=dict)
    run: str | None = None

    @property
    def total(self) -> int:
        return self.valid + self.invalid

    def percent(self, rows: int) -> float:
        return rows / self.total * 100 if self.total else 0.0


@dataclass(frozen=True)
class Watch:
    """Counters of the lookup and of the install resolution, filled by the first action."""

    hydration: Observation | None
    resolution: Observation

    @classmethod
    def over(cls, supplement: DataFrame | None) -> Watch:
        return cls(None if supplement is None else Observation(), Observation())

    def counts(self) -> dict[str, dict[str, int]]:
        seen = {} if self.hydration is None else dict(self.hydration.get)
        return {"hydration": seen, "resolution": dict(self.resolution.get)}


def shared_folder(spark: SparkSession) -> str | None:
    """The shared folder of the cluster for intermediate tables, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None)


def staging_folder(
    spark: SparkSession, supplement: DataFrame | None, staging: str | None, output: str
) -> str | None:
    """Where a job keeps its joined rows: one folder for each output, used again by a rerun.

    Without a supplement nothing is joined, and rows are staged only if a place is given.
    """
    place = staging or (shared_folder(spark) if supplement is not None else None)
    if place is None:
        return None
    if staging and is_local(spark, staging) and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"executors do not share the local folder {staging}: name a shared one")
    return f"{place}/listings-{hashlib.sha256(output.encode()).hexdigest()[:16]}"


def staged(marked: DataFrame, path: str, format: str = "parquet") -> tuple[DataFrame, bool | None]:
    """Write checked rows once, split by validity, and go on from the written table.

    The two outputs then read one partition each instead of repeating the lookup join,
    and a lost executor costs no more than the tasks it ran. Whether a valid row has a number
    of months is observed on the way, so that nothing is read again to learn it.
    """
    given, seen = None, Observation()
    rows = marked
    if MONTHS in marked.columns:
        number = F.col(VALID) & safe_double(MONTHS).isNotNull()
        rows = marked.observe(seen, F.count_if(number).alias("given"))
    rows.write.partitionBy(VALID).format(format).mode("overwrite").save(path)
    if MONTHS in marked.columns:
        given = seen.get["given"] > 0
    return marked.sparkSession.read.schema(marked.schema).format(format).load(path), given


def write_result(
    result: EnrichResult,
    output: str,
    invalid_output: str,
    *,
    format: str = "csv",
    mode: str = "errorifexists",
) -> JobReport:
    """Write both outputs, invalid rows first; each is written even when it is empty."""
    rejected, enriched = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    empties = [total_of(is_empty(c)).alias(c) for c in REQUIRED_COLUMNS]
    flags = [total_of(F.col(c)).alias(c) for c in result.flags]
    hits = sum((F.col(c) for c in result.rules.categories), F.lit(0))
    assigned = F.count_if(hits > 0).alias("__assigned")
    writer(result.invalid.observe(rejected, rows, *empties), format, mode).save(invalid_output)
    writer(result.valid.observe(enriched, rows, assigned, *flags), format, mode).save(output)
    bad, good = dict(rejected.get), dict(enriched.get)
    valid, with_category = good.pop("rows"), good.pop("__assigned")
    return JobReport(
        valid=valid,
        invalid=bad.pop("rows"),
        empty_cells={c: n for c, n in bad.items() if n},
        coverage=good,
        assignment={"assigned": with_category, "unassigned": valid - with_category},
    )


def _write(
    marked: DataFrame,
    watch: Watch,
    folder: str | None,
    output: str,
    invalid_output: str,
    rules: CategoryRules | None,
    months_policy: str | None,
    format: str,
    mode: str,
    publishing: bool,
) -> JobReport:
    """Stage, write both outputs, publish them together if asked to, and clear the staging."""
    spark = marked.sparkSession
    run = new_run() if publishing else None
    valid_path = f"{output}/{run}" if run else output
    invalid_path = f"{invalid_output}/{run}" if run else invalid_output
    try:
        rows, given = staged(marked, folder) if folder else (marked, None)
        result = result_of_marked(rows, rules, months_policy, given)
        report = write_result(result, valid_path, invalid_path, format=format, mode=mode)
    finally:
        if folder:
            remove_folder(spark, folder)
    report = replace(report, run=run, **watch.counts())
    if run:
        entries = {"valid": valid_path, "invalid": invalid_path, "invalid_folder": invalid_output, "format": format}
        publish(spark, output, run, entries | {"report": asdict(report)})
    return report


def run_enrichment(
    spark: SparkSession,
    input_path: str | list[str],
    output: str,
    invalid_output: str,
    *,
    supplement: DataFrame | None = None,
    rules: CategoryRules | None = None,
    months_policy: str | None = None,
    input_format: str = "csv",
    csv_options: dict | None = None,
    partitions: int | None = None,
    output_format: str = "csv",
    mode: str = "errorifexists",
    staging: str | None = None,
    publishing: bool = False,
    **lookup_options,
) -> JobReport:
    """Read listings, write enriched valid rows and untouched invalid rows.

    With a supplement the joined rows are staged in ``staging``, or else in the shared
    folder of the cluster, and removed afterwards; without either they are computed once
    per output. ``publishing=True`` writes both outputs under the name of the run and makes
    them current together, for ``read_published``; otherwise the folders are the outputs.
    ``csv_options`` go to ``read_csv``, ``partitions`` deals the input out anew.
    """
    watch = Watch.over(supplement)
    folder = staging_folder(spark, supplement, staging, output)
    listings = read_listings(spark, input_path, input_format, **(csv_options or {}))
    marked = check_listings(
        with_partitions(listings, partitions),
        supplement,
        observed=watch.hydration,
        resolution=watch.resolution,
        **lookup_options,
    )
    return _write(
        marked, watch, folder, output, invalid_output, rules, months_policy, output_format, mode, publishing
    )


def run_imputation(
    spark: SparkSession,
    input_path: str | list[str],
    output: str,
    *,
    seed: int = 0,
    input_format: str = "csv",
    csv_options: dict | None = None,
    format: str = "csv",
    mode: str = "errorifexists",
) -> dict[str, int]:
    """Read rows, write all of them with the fillable columns filled.

    The counts are observed on the rows as they are written.
    """
    rows = add_missing(
        read_for_imputation(spark, input_path, input_format, **(csv_options or {})), FILLABLE_COLUMNS
    )
    seen = Observation()
    cells = sum((is_empty(c).cast("bigint") for c in FILLABLE_COLUMNS), F.lit(0).cast("bigint"))
    rows = rows.observe(
        seen, F.count(F.lit(1)).alias("input_rows"), total_of(cells).alias("filled_cells")
    )
    writer(impute_listing_metrics(rows, seed), format, mode).save(output)
    return dict(seen.get)


def run_keys(
    spark: SparkSession,
    input_path: str | list[str],
    keys: DataFrame,
    output: str,
    invalid_output: str,
    *,
    supplement: DataFrame | None = None,
    rules: CategoryRules | None = None,
    months_policy: str | None = None,
    order_by: list[str] | None = None,
    hot_rows: int | None = None,
    seed: int = 0,
    input_format: str = "csv",
    csv_options: dict | None = None,
    output_format: str = "csv",
    mode: str = "errorifexists",
    staging: str | None = None,
    publishing: bool = False,
) -> JobReport:
    """Enrich the rows of some keys from paths to paths, staged and published as in ``run_enrichment``."""
    watch = Watch.over(supplement)
    folder = staging_folder(spark, supplement, staging, output)
    found = enrich_keys(
        read_listings(spark, input_path, input_format, **(csv_options or {})),
        keys,
        supplement,
        seed=seed,
        order_by=order_by,
        hot_rows=hot_rows,
        observed=watch.hydration,
        resolution=watch.resolution,
    )
    return _write(
        found.marked, watch, folder, output, invalid_output, rules, months_policy, output_format, mode, publishing
    )
