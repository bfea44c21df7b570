"""Exact top-k by inner product over vectors sorted by length.

Vectors are rotated by the eigenvectors of their second-moment matrix, so that the first
coordinates carry most of a product, and cut into blocks by descending length. The block
of the longest vectors gives each query a floor for its k-th score. Every other pair of
query and vector blocks starts from that floor: a query skips a block whose longest vector can't
reach it, and within a block the partial sum over the leading coordinates plus the
product of the remainders' lengths (Cauchy-Schwarz) drops most vectors; the rest are
scored exactly in integers. A block returns at most k rows a query, which are ranked.

Defined results: vectors that are null or hold null or non-finite components take no part;
neither do rows without an id; vectors meet only those with as many components; rows with
the query's id are its own, and of those the one with the
smallest vector asks; ties go to the smaller id; an empty table gives no rows.
Scores must fit 62 bits; larger components raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appfacet.llm.common import cut, importable

BLOCK = 4096
QUERY_BLOCK = 4096
LEAD = 16
_ROUNDING = 1e-6


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, v, dim, norm2): components floor(scale * x), of vectors that take part."""
    x = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("x"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    x = x.filter("vec_id IS NOT NULL AND x IS NOT NULL").filter(~F.exists("x", bad))
    v = x.select("vec_id", F.transform("x", lambda c: F.floor(F.lit(scale) * c).cast("long")).alias("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    return v.select("vec_id", "v", F.size("v").alias("dim"), norm2.alias("norm2"))


def _moments(batches):
    sums: dict[int, np.ndarray] = {}
    for pdf in batches:
        for dim, part in pdf.groupby("dim"):
            m = np.stack(part["v"].to_numpy()).astype(np.float64).reshape(len(part), int(dim))
            sums[int(dim)] = sums.get(int(dim), 0) + m.T @ m
    yield pd.DataFrame({"dim": [*sums], "m": [m.ravel().tolist() for m in sums.values()]}, columns=["dim", "m"])


def rotations(vectors: DataFrame) -> dict[int, np.ndarray]:
    """By dimension, eigenvectors of the second moments, the largest first; a matrix a dimension."""
    parts = vectors.select("dim", "v").mapInPandas(_moments, "dim int, m array<double>")
    summed = parts.select("dim", F.posexplode("m").alias("at", "x")).groupBy("dim", "at").agg(F.sum("x").alias("x"))
    out: dict[int, list[tuple[int, float]]] = {}
    for row in summed.collect():
        out.setdefault(row["dim"], []).append((row["at"], row["x"]))
    return {dim: np.linalg.eigh(np.array([x for _, x in sorted(m)]).reshape(dim, dim))[1][:, ::-1] for dim, m in out.items()}


def _pairs(queries: pd.DataFrame, rows: pd.DataFrame, rotation: np.ndarray, k: int, floors: np.ndarray) -> pd.DataFrame:
    """At most k best rows per query with a score no less than the query's floor."""
    q, v = np.stack(queries["v"].to_numpy()), np.stack(rows["v"].to_numpy())
    ids, q_ids = rows["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    qf, vf = q.astype(np.float64), v.astype(np.float64)
    qr, vr = qf @ rotation, vf @ rotation
    lead = min(LEAD, q.shape[1])
    q_len, v_len = np.sqrt((qf * qf).sum(1)), np.sqrt((vf * vf).sum(1))
    q_rest, v_rest = np.sqrt((qr[:, lead:] ** 2).sum(1)), np.sqrt((vr[:, lead:] ** 2).sum(1))
    if q.size and v.size and float(q_len.max()) * float(v_len.max()) >= 2.0**62:
        raise OverflowError("inner products beyond 62 bits")
    out = []
    for i in range(len(q)):
        slack = 1 + _ROUNDING * (1 + q_len[i] * v_len.max())
        reach = int(np.searchsorted(-v_len, -((floors[i] - slack) / q_len[i]), side="right")) if q_len[i] > 0 and np.isfinite(floors[i]) else len(v)
        bound = vr[:reach, :lead] @ qr[i, :lead] + q_rest[i] * v_rest[:reach] + slack
        left = np.nonzero((bound >= floors[i]) & (ids[:reach] != q_ids[i]))[0]
        scores = v[left] @ q[i]
        near = np.lexsort((ids[left], -scores))[:k]
        near = near[scores[near] >= floors[i]]
        out.append(pd.DataFrame({"query_id": np.full(len(near), q_ids[i]), "vec_id": ids[left][near], "score": scores[near]}))
    return pd.concat(out)


def top_inner_products(vectors: DataFrame, k: int = 5, every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): per row with an id divisible by `every` its k best others."""
    importable(vectors)
    rows = cut(integer_vectors(vectors, vec_id, embedding, scale))
    turned = rotations(rows)
    # blocks by descending length: the range partition is the block's head, then pieces of it
    n = rows.count()
    parts = max(1, -(-n // BLOCK))
    ranged = rows.repartitionByRange(parts, "dim", F.desc("norm2"), "vec_id").select("*", F.spark_partition_id().alias("part"))
    place = F.floor((F.row_number().over(Window.partitionBy("part", "dim").orderBy(F.desc("norm2"), "vec_id")) - 1) / BLOCK)
    blocks = cut(ranged.withColumn("piece", place.cast("int")))
    heads = blocks.groupBy("dim", "part", "piece").agg(F.max("norm2").alias("longest"))
    first = heads.groupBy("dim").agg(F.max(F.struct("longest", -F.col("part"), -F.col("piece"))).alias("h")).select("dim", (-F.col("h.col2")).alias("part"), (-F.col("h.col3")).alias("piece"))
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "dim", "norm2")).alias("q")).select("vec_id", "q.*")
    queries = queries.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n // (every * QUERY_BLOCK)))))
    columns = "query_id long, vec_id long, score long"

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        right = right.rename(columns={f"at_{c}": c for c in ("vec_id", "v", "norm2")}).sort_values(["norm2", "vec_id"], ascending=[False, True])
        floors = left["floor"].fillna(-np.inf).to_numpy(np.float64)
        dim = int(left["dim"].iloc[0])
        return _pairs(left, right, turned.get(dim, np.eye(dim)), k, floors)

    def against(asked: DataFrame, chosen: DataFrame) -> DataFrame:
        """`asked` (vec_id, v, dim, norm2, group, floor) against the blocks in `chosen`."""
        key = ["dim", "part", "piece", "group"]
        # a block meets a group of queries only if its longest vector may reach some floor
        reach = asked.groupBy("dim", "group").agg(F.max("norm2").alias("q2"), F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("least"))
        met = chosen.join(reach, "dim").filter((F.col("least") <= 0) | (F.col("longest") * F.col("q2") * 1.0001 >= F.col("least") * F.col("least"))).select(*key)
        left = asked.join(met, ["dim", "group"])
        right = blocks.join(met, ["dim", "part", "piece"])
        right = right.select(*(F.col(c).alias(f"of_{c}") for c in key), *(F.col(c).alias(f"at_{c}") for c in ("vec_id", "v", "norm2")))
        return left.groupBy(*key).cogroup(right.groupBy(*(f"of_{c}" for c in key))).applyInPandas(lambda a, b: best(a, b), columns)

    empty_floor = queries.withColumn("floor", F.lit(None).cast("double"))
    head = cut(against(empty_floor, heads.join(first, ["dim", "part", "piece"])))
    floor = head.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    rest = against(queries.join(floor.withColumnRenamed("query_id", "vec_id"), "vec_id", "left"), heads.join(first, ["dim", "part", "piece"], "left_anti"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return head.unionByName(rest).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
