"""Reading and writing of listing tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from ..operators.columns import as_text, lower_names

# The texts that a delimited file may hold for "missing".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def nullify(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """NULL for every text cell that equals one of the tokens."""
    tokens = list(tokens)
    return df.select(
        *[
            F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c)
            if kind == "string"
            else F.col(f"`{c}`")
            for c, kind in df.dtypes
        ]
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    null_tokens: Iterable[str] = NULL_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """Delimited listings with a header row, all columns as text.

    Quoted fields may hold line breaks, so by default a file is one input split; pass
    ``multi_line=False`` for files without such breaks to read large ones in parallel.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )
    return nullify(raw, null_tokens)


def read_table(spark: SparkSession, path: str | list[str], format: str = "parquet") -> DataFrame:
    """Listings in a columnar format, all columns as text."""
    return as_text(spark.read.format(format).load(path))


def with_partitions(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal the rows out to ``partitions``; as they are read without it.

    Worth its shuffle for few large splits, as of multi-line files: the term search is
    bound by computation.
    """
    return df if partitions is None else df.repartition(partitions)


def read_listings(
    spark: SparkSession, path: str | list[str], format: str = "csv", **csv_options
) -> DataFrame:
    """Listings in any format; ``csv_options`` are those of ``read_csv``."""
    return read_csv(spark, path, **csv_options) if format == "csv" else read_table(spark, path, format)


def read_for_imputation(
    spark: SparkSession, path: str | list[str], format: str = "csv", **csv_options
) -> DataFrame:
    """Rows for the imputer: names in lower case, no renaming of the key."""
    return lower_names(read_listings(spark, path, format, **csv_options))


def writer(df: DataFrame, format: str = "csv", mode: str = "errorifexists") -> DataFrameWriter:
    """Writer of a dataset folder; text keeps its white space and empty cells stay empty."""
    out = df.write.format(format).mode(mode)
    if format == "csv":
        out = (
            out.option("header", True)
            .option("escape", '"')
            .option("emptyValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    return out
