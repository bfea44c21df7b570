"""Shaping of column names and types before and after the feature work."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import KEY, PASSTHROUGH_COLUMNS, REQUIRED_COLUMNS

# Fixed value: the other accepted name of the key column.
KEY_ALIAS = "pub_bundle"


def find_column(df: DataFrame, name: str) -> str | None:
    """The column called ``name`` in any letter case, the exact spelling first."""
    if name in df.columns:
        return name
    matches = [c for c in df.columns if c.lower() == name.lower()]
    if len(matches) > 1:
        raise ValueError(f"columns {matches} differ only in letter case")
    return matches[0] if matches else None


def column_or(df: DataFrame, name: str, default: Column) -> Column:
    """The column in any letter case, or ``default`` where the table has none."""
    found = find_column(df, name)
    return default if found is None else F.col(f"`{found}`")


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case all column names; names that would collide are an error."""
    names = [c.lower() for c in df.columns]
    doubled = sorted({c for c in names if names.count(c) > 1})
    if doubled:
        raise ValueError(f"columns {doubled} occur more than once in different letter case")
    return df.toDF(*names)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case names and settle which column is the key."""
    df = lower_names(df)
    if KEY in df.columns:
        return df
    if KEY_ALIAS in df.columns:
        return df.withColumnRenamed(KEY_ALIAS, KEY)
    if len(df.columns) == 1:
        return df.withColumnRenamed(df.columns[0], KEY)
    return df


def text_of(name: str, kind: T.DataType) -> Column:
    """A value as text, as it would read in a delimited file.

    NaN counts as missing; whole doubles lose their ``.0`` so that ``1.0`` reads as ``1``,
    up to 38 digits.
    """
    value = F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        digits = F.when(value % 1 == 0, value.try_cast("decimal(38,0)").cast("string"))
        return F.when(~F.isnan(value), F.coalesce(digits, value.cast("string")))
    return value.cast("string")


def cell(name: str, kind: T.DataType) -> Column:
    """A column as text, whatever its type."""
    return F.col(f"`{name}`") if isinstance(kind, T.StringType) else text_of(name, kind)


def as_text(df: DataFrame) -> DataFrame:
    """All columns as strings, so that one set of text rules holds for any source."""
    return df.select(
        *[
            F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.StringType)
            else text_of(f.name, f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def add_missing(df: DataFrame, names: Iterable[str], value: str | None = "") -> DataFrame:
    """Append absent columns with a constant text."""
    absent = {c: F.lit(value).cast("string") for c in names if c not in df.columns}
    return df.withColumns(absent) if absent else df


def add_required(df: DataFrame) -> DataFrame:
    return add_missing(df, REQUIRED_COLUMNS)


def passthrough(df: DataFrame, months: Column) -> DataFrame:
    """The 14 columns carried to the output; absent ones are empty text."""
    carried = [
        F.col(c) if c in df.columns else F.lit("").alias(c)
        for c in PASSTHROUGH_COLUMNS
        if c != "months_since_launch"
    ]
    return df.select(*carried, months.alias("months_since_launch"))


def final_select(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fixed columns in fixed order; absent ones are NULL (integers, as all flags are)."""
    kinds = {c: "string" for c in PASSTHROUGH_COLUMNS} | {"months_since_launch": "bigint"}
    return df.select(
        *[
            F.col(c) if c in df.columns else F.lit(None).cast(kinds.get(c, "int")).alias(c)
            for c in names
        ]
    )
