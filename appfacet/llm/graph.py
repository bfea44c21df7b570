"""Connected components and compact id filters, for operators on pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import cut

FILTER_WORDS = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of the ids in `edges` (a, b): the smallest id that links reach.

    Each round an id, its parent and its grandparent take the smallest grandparent among
    the neighbours, so that trees of parents are hooked and flattened at once and the number
    of rounds follows the logarithm of a chain's length. Minima are combined before they are
    shuffled, so an id with many neighbours isn't gathered in one task.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct())
    parents = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("parent")).select(F.col("a").alias("id"), "parent"))
    while True:
        up = parents.select(F.col("id").alias("up_id"), F.col("parent").alias("grand"))
        now = parents.join(up, F.col("parent") == F.col("up_id")).select("id", "parent", "grand")
        near = both.join(now.select(F.col("id").alias("near_id"), F.col("grand").alias("near_grand")), F.col("b") == F.col("near_id"))
        least = near.groupBy("a").agg(F.min("near_grand").alias("least"))
        offered = now.join(least, F.col("id") == F.col("a")).select("id", "parent", F.least("grand", "least").alias("offer"))
        offers = offered.select("id", F.least("offer", "parent").alias("parent")).union(offered.select(F.col("parent").alias("id"), F.col("offer").alias("parent")))
        following = cut(offers.groupBy("id").agg(F.min("parent").alias("parent")))
        before = parents.select(F.col("id").alias("b_id"), F.col("parent").alias("b_parent"))
        changed = following.join(before, F.col("id") == F.col("b_id")).filter(F.col("parent") != F.col("b_parent"))
        parents = following
        if changed.isEmpty():
            return parents.select("id", F.col("parent").alias("component"))


def id_filter(ids: DataFrame, column: str, words: int = FILTER_WORDS) -> np.ndarray:
    """A bit per residue of the ids in `words` words, 512 kB if not told otherwise, for scans to pass over most other rows.

    What passes must still be joined: with very many ids the filter fills and only saves less.
    """
    key = F.col(column)
    word = F.pmod(key, F.lit(words)).cast("int").alias("word")
    bit = F.expr(f"shiftleft(1L, CAST(pmod(shiftright(`{column}`, 40), 64) AS INT))")
    rows = ids.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()  # at most `words` rows
    out = np.zeros(words, np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out


def passes(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit ids may be in the filter."""
    return (bits[ids % len(bits)] >> ((ids >> 40) % 64)) & 1 == 1
