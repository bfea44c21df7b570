"""Joins that stay balanced when single keys hold a large share of the rows.

A mergeable sketch finds the keys above ``hot_rows`` rows and how many rows they have; they get
as many shares as it takes to bring each below that number. Rows of such a key take a share
before anything is shuffled, and the rows of the other side are repeated once per share, so
that every row meets exactly the rows of its key: the result is that of the plain join.

The sketch is made per task, merged in groups of tasks, and gives at most ``MOST_HOT`` keys;
that table is small whatever the data, so it is broadcast and no row moves to learn its share.
A key outside it holds less than about one in ``MOST_HOT`` of all rows. A share follows from
a hash of the row and its input partition: a retried task assigns it again the same way, and
equal rows are dealt out by the partitions they come from.

Without ``hot_rows`` the joins are plain ones, whose skew adaptive execution handles where the
other side has one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: keys that a sketch reports, and counters it keeps for them
MOST_HOT, COUNTERS = 1024, 8192
#: groups of tasks whose sketches are merged before the last step
GROUPS = 128

_KEY, _SHARES, _SHARE = "__hot_key", "__shares", "__share"


def hot_keys(df: DataFrame, key: Column, hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and how many multiples of it they hold."""
    keys = df.where(key.isNotNull()).select(
        key.alias(_KEY), F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("group")
    )
    sketches = keys.groupBy("group").agg(
        F.expr(f"approx_top_k_accumulate({_KEY}, {COUNTERS})").alias("sketch")
    )
    # grouped by a constant, so that an empty table gives no sketch
    merged = sketches.groupBy(F.lit("all").alias("of")).agg(
        F.expr(f"approx_top_k_combine(sketch, {COUNTERS})").alias("sketch")
    )
    found = merged.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {MOST_HOT})")))
    return found.where(F.col("count") > hot_rows).select(
        F.col("item").alias(_KEY), F.ceil(F.col("count") / hot_rows).cast("int").alias(_SHARES)
    )


def _shares(hot_rows: int) -> Column:
    """Shares enough for rows that fall into them at random.

    With four standard deviations above its mean a share has no more than ``hot_rows`` rows.
    """
    mean = max(1.0, ((hot_rows + 4) ** 0.5 - 2) ** 2)
    return F.ceil(F.col(_SHARES) * (hot_rows / mean)).cast("int")


def _known_hot(df: DataFrame, key: Column, hot: DataFrame, hot_rows: int) -> DataFrame:
    """``df`` with the number of shares of its key, by a table of at most ``MOST_HOT`` rows."""
    small = F.broadcast(hot.withColumn(_SHARES, _shares(hot_rows)))
    return df.join(small, key == F.col(_KEY), "left").drop(_KEY)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def with_share(df: DataFrame, key: Column, hot: DataFrame, hot_rows: int) -> DataFrame:
    """Give rows of hot keys their share; NULL keys match nothing and spread freely."""
    columns = [F.col(f"`{f.name}`") for f in df.schema if _hashable(f.dataType)]
    spot = F.pmod(F.xxhash64(*columns), F.col(_SHARES)) + F.spark_partition_id()
    share = (
        F.when(key.isNull(), F.spark_partition_id())
        .when(F.col(_SHARES).isNotNull(), F.pmod(spot, F.col(_SHARES)).cast("int"))
        .otherwise(F.lit(0))
    )
    return _known_hot(df, key, hot, hot_rows).withColumn(_SHARE, share).drop(_SHARES)


def per_share(df: DataFrame, key: Column, hot: DataFrame, hot_rows: int) -> DataFrame:
    """Repeat rows once per share of their key."""
    shares = F.sequence(F.lit(0), F.coalesce(F.col(_SHARES), F.lit(1)) - 1)
    return _known_hot(df, key, hot, hot_rows).withColumn(_SHARE, F.explode(shares)).drop(_SHARES)


def _same_type(left: DataFrame, right: DataFrame, key: str) -> Column:
    """The key as both sides compare it; as a hash where a sketch has no place for its type."""
    kind = left.select(key).union(right.select(key)).schema[0].dataType
    simple = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return F.col(key).cast(kind) if isinstance(kind, simple) else F.xxhash64(F.col(key).cast(kind))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot_rows: int | None = None,
) -> DataFrame:
    """Join ``right`` to ``left`` on one equally named column; ``left`` may be skewed.

    ``how`` is any type that keeps left rows apart: inner, left, left_semi, left_anti.
    """
    if hot_rows is None or left.isStreaming:
        return left.join(right, key, how)
    compared = _same_type(left, right, key)
    hot = hot_keys(left, compared, hot_rows)
    joined = with_share(left, compared, hot, hot_rows).join(
        per_share(right, compared, hot, hot_rows), [key, _SHARE], how
    )
    return joined.drop(_SHARE)


def attach_features(
    base: DataFrame, parts: list[DataFrame], on: str, hot_rows: int | None = None
) -> DataFrame:
    """Left-join feature frames to ``base`` one after another on one key.

    A key that occurs several times on both sides fans out to all its combinations, as a
    left join does. With ``hot_rows``, keys above so many rows on either side are split.
    """
    names = [c for c in base.columns] + [c for p in parts for c in p.columns if c != on]
    doubled = sorted({c for c in names if names.count(c) > 1})
    if doubled:
        raise ValueError(f"feature columns {doubled} occur in more than one frame")
    for part in parts:
        if hot_rows is None or base.isStreaming:
            base = base.join(part, on, "left")
        else:
            base = _both_spread(base, part, on, hot_rows)
    return base


def _both_spread(left: DataFrame, right: DataFrame, on: str, hot_rows: int) -> DataFrame:
    """A left join whose hot keys, on either side, meet in a grid of shares."""
    key = _same_type(left, right, on)
    l_hot, r_hot = hot_keys(left, key, hot_rows), hot_keys(right, key, hot_rows)
    l_side = with_share(left, key, l_hot, hot_rows).withColumnRenamed(_SHARE, "__left_share")
    r_side = with_share(right, key, r_hot, hot_rows).withColumnRenamed(_SHARE, "__right_share")
    l_side = per_share(l_side, key, r_hot, hot_rows).withColumnRenamed(_SHARE, "__right_share")
    r_side = per_share(r_side, key, l_hot, hot_rows).withColumnRenamed(_SHARE, "__left_share")
    met = l_side.join(r_side, [on, "__left_share", "__right_share"]).drop("__left_share", "__right_share")
    known = right.select(on).distinct()
    alone = spread_join(left, known, on, "left_anti", hot_rows)
    return met.unionByName(alone, allowMissingColumns=True)
