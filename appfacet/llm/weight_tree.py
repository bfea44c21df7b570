"""Mixing sources to target weights, with DataFrame functions only.

Budgets go down a tree of levels (domain, language, source). At each level a parent's
budget is shared among its children by weight; a child that has less than its share gives
the rest to its siblings, and only what no child can take was never the parent's: its
capacity is the sum of theirs, so such a shortage has gone to the parent's siblings
before. Sharing is a water level found with window sums, without iteration. A leaf's
quota is filled with whole epochs and a token-prefix of one more: documents in the order
of a seeded digest up to the last that fits. The cut is found from sums per bucket of
digests, so that a leaf with most of the rows isn't ordered in one task.

Levels and weights are SQL expressions, of a document's columns and of the levels.

Defined results: a null text has 0 tokens; null levels form a node of their own; weights
below 1 give nothing; rows with one id share their place in the order and are taken
together; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appfacet.llm.common import cut, free_name

WORD = r"[^\x20\x09-\x0D]+"
MOST_BROADCAST_LEAVES = 20_000
SALTS = 32


def n_words(text: Column) -> Column:
    """Words of a text, used as its tokens."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def share(children: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """`children` with `budget` shared from `of` by `weight` within `capacity`.

    Children ordered by capacity over weight fill up in that order; the first that doesn't
    sets the level for all after it. Integer shares come from cumulative weights.
    """
    order = [F.col("capacity").cast("double") / F.col("weight"), F.col(name)]
    base = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before, after = base.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1), base.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    big = lambda c: F.col(c).cast("decimal(19,0)")
    marked = children.withColumn("used", F.coalesce(F.sum("capacity").over(before), F.lit(0))).withColumn("open_weight", F.sum("weight").over(after))
    full = big("capacity") * big("open_weight") <= (big("of") - big("used")) * big("weight")
    marked = marked.withColumn("full", full)
    marked = marked.withColumn("left", F.col("of") - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(whole))
    marked = marked.withColumn("level_weight", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole))
    marked = marked.withColumn("w_before", F.coalesce(F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(before), F.lit(0)))
    part = lambda w: f"(CAST(left AS decimal(19,0)) * CAST({w} AS decimal(19,0))) div CAST(greatest(level_weight, 1) AS decimal(19,0))"
    budget = F.when(F.col("full"), F.col("capacity")).otherwise(F.expr(f"{part('w_before + weight')} - {part('w_before')}"))
    return marked.withColumn("budget", budget.cast("long")).drop("used", "open_weight", "full", "left", "level_weight", "w_before")


def leaf_quotas(leaves: DataFrame, levels: Sequence[str], weights: Sequence[str], percent: int, epochs: int) -> DataFrame:
    """`leaves` (levels and tokens) with `quota`. The whole budget is `percent` % of all tokens."""
    tree = leaves
    for i, weight in enumerate(weights):
        tree = tree.withColumn(f"weight{i}", F.expr(weight).cast("long"))
    for i in range(len(levels)):
        tree = tree.filter(F.col(f"weight{i}") > 0)
    tree = tree.withColumn("capacity", F.col("tokens") * epochs)
    budgets = None
    for i, name in enumerate(levels):
        path, parent = [*levels[: i + 1]], [*levels[:i]]
        nodes = tree.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.max(f"weight{i}").alias("weight"))
        if budgets is None:
            nodes = nodes.withColumn("of", F.lit((leaves.agg(F.sum("tokens")).first()[0] or 0) * percent // 100))
        else:
            nodes = nodes.join(budgets.withColumnRenamed("budget", "of"), parent)
        budgets = share(nodes, parent, name).select(*path, "budget")
    return leaves.join(budgets.withColumnRenamed("budget", "quota"), [*levels], "left").withColumn("quota", F.coalesce("quota", F.lit(0)))


def with_leaf(rows: DataFrame, leaves: DataFrame, levels: Sequence[str]) -> DataFrame:
    """`rows` joined to their leaf; leaves are broadcast while they are few, else joined on salted keys."""
    if leaves.count() <= MOST_BROADCAST_LEAVES:
        return rows.join(F.broadcast(leaves), [*levels])
    salted = leaves.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, [*levels, "salt"]).drop("salt")


def plan_mix(docs: DataFrame, levels: dict[str, str], weights: Sequence[str], percent: int, epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The documents' levels and tokens, and the leaves with quota, whole epochs and cut."""
    names = [*levels]
    meta = cut(docs.select("doc_id", *(F.coalesce(F.expr(c).cast("string"), F.lit("")).alias(n) for n, c in levels.items()), n_words(F.col("text")).alias("n_tokens")))
    leaves = meta.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    quotas = leaf_quotas(leaves, names, weights, percent, epochs)
    some = F.greatest("tokens", F.lit(1))
    quotas = cut(quotas.withColumn("whole", F.expr("quota div greatest(tokens, 1)")).withColumn("rest", F.col("quota") % some))
    placed = with_leaf(meta, quotas.select(*names, "whole", "rest"), names).filter("rest > 0").withColumn("digest", seeded(seed, F.col("whole")))
    placed = placed.withColumn("bucket", F.substring("digest", 1, 3))
    sums = placed.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("in_bucket"), F.max("rest").alias("rest"))
    upto = F.sum("in_bucket").over(Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    edge = sums.withColumn("upto", upto).filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("in_bucket") <= F.col("rest")))
    # the bucket in which the rest runs out; in a leaf without one all documents would fit
    edge = edge.groupBy(*names).agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("in_bucket")).alias("before")), "bucket").alias("edge")).select(*names, "edge.*")
    inside = placed.join(edge.withColumnRenamed("bucket", "edge_bucket"), names).filter(F.col("bucket") == F.col("edge_bucket"))
    upto = F.col("before") + F.sum("n_tokens").over(Window.partitionBy(*names).orderBy("digest").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    last = inside.withColumn("upto", upto).filter(F.col("upto") <= F.col("rest")).groupBy(*names).agg(F.max("digest").alias("last"))
    cuts = edge.select(*names, "bucket").join(last, names, "left").select(*names, F.coalesce("last", "bucket").alias("last"))
    return meta, cut(quotas.join(cuts, names, "left"))


def seeded(seed: int, whole: Column) -> Column:
    """Order of a document within the epoch after its leaf's whole ones."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), whole.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def taken_epochs(seed: int, whole: Column, rest: Column, last: Column) -> Column:
    """Times that a row is taken."""
    return whole + F.when((rest > 0) & (seeded(seed, whole) <= last), 1).otherwise(0)


def mix(docs: DataFrame, levels: dict[str, str], weights: Sequence[str], percent: int, epochs: int, seed: int = 7) -> DataFrame:
    """Chosen documents, one row per epoch: doc_id, the levels, n_tokens, epoch."""
    meta, leaves = plan_mix(docs, levels, weights, percent, epochs, seed)
    rows = with_leaf(meta, leaves.drop("tokens", "quota"), [*levels]).withColumn("times", taken_epochs(seed, F.col("whole"), F.col("rest"), F.col("last")))
    return rows.filter("times > 0").select("doc_id", *levels, "n_tokens", F.explode(F.sequence(F.lit(0), F.col("times").cast("int") - 1)).alias("epoch"))


def mix_once(docs: DataFrame, levels: dict[str, str], weights: Sequence[str], percent: int, seed: int = 7) -> DataFrame:
    """The rows of `docs` that a single epoch takes, with all their columns."""
    _, leaves = plan_mix(docs, levels, weights, percent, 1, seed)
    names = {n: free_name(docs, f"{n}_") for n in levels}
    leaf = free_name(docs, "leaf")
    leaves = leaves.select(*(F.col(n).alias(own) for n, own in names.items()), F.struct("whole", "rest", "last").alias(leaf))
    keyed = docs.withColumns({own: F.coalesce(F.expr(levels[n]).cast("string"), F.lit("")) for n, own in names.items()})
    times = taken_epochs(seed, *(F.col(f"{leaf}.{c}") for c in ("whole", "rest", "last")))
    return with_leaf(keyed, leaves, [*names.values()]).filter(times > 0).select(*docs.columns)
