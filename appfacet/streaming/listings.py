"""The row-level flow on Structured Streaming tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.enrich import EnrichResult, enrich_listings
from ..sources.rules import CategoryRules


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet"
) -> DataFrame:
    """Listings arriving as files in a folder."""
    return spark.readStream.schema(schema).format(format).load(path)


def enrich_stream(
    listings: DataFrame,
    supplement: DataFrame | None = None,
    *,
    rules: CategoryRules | None = None,
    order_by: list[str] | None = None,
) -> EnrichResult:
    """Enrich a stream: stateless projections and, with a static supplement, a left join.

    Months follow the row policy, since a stream has no "any row of the dataset".
    """
    return enrich_listings(
        listings, supplement, rules=rules, months_policy="row", order_by=order_by, hot_rows=None
    )


def write_stream(
    df: DataFrame, path: str, checkpoint: str, *, format: str = "parquet", once: bool = True
) -> StreamingQuery:
    """Append a stream to a folder; ``once`` stops after the rows that are there now."""
    out = (
        df.writeStream.format(format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return (out.trigger(availableNow=True) if once else out).start()
