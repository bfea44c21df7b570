"""Toxicity by maximum-scoring segments of token log-odds.

Labelled texts with a word are counted by class (equal texts of a class once), and the
word's log-odds under an informative Dirichlet prior, less two deviations, say how surely
it belongs to toxic texts. Words above a limit score that, all others a small negative
drift, so a toxic passage is a segment with a high sum. A linear scan finds every maximal segment. Segment sums are
normalised by extreme-value theory: with lambda the root of E[exp(lambda * score)] = 1
over the clean words, lambda * sum - ln(n) follows a Gumbel law in clean texts of n words,
so segments above `significant` are reported and add up. A logistic curve, fitted on a
histogram of the training texts' sums, turns the total into a score from 0 to 1.

Defined results: a text without a scoring word, null and empty ones included, scores the curve's
value at the least total; without
labels of both classes, or without a word above the limit, every score is 0; repeated rows
each get a row; rows with a null id are scored and never trained on.
"""

from __future__ import annotations

import math
import string
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import cut, map_batches

FOLDS, HELD_OUT = 5, 0
#: bound of the labelled rows that are broadcast for training, chosen by a digest of the id
MOST_LABELS = 200_000
#: bound of the words with a score
MOST_WORDS = 20_000
#: prior counts of every word, and of all words together by their share
BASE_PRIOR, SHARED_PRIOR = 0.5, 50.0
#: deviations taken off the log-odds, and the least that must be left
DEVIATIONS, LEAST_SCORE, LEAST_TOXIC = 2.0, 1.5, 3
DRIFT = -0.1
STEP = 0.25
#: the total of texts without a scoring word, empty ones included
LEAST_TOTAL = -12.0
_PUNCTUATION = str.maketrans({c: " " for c in string.punctuation})


def words_of(text: str | None) -> list[str]:
    return text.lower().translate(_PUNCTUATION).split() if text else []


def segments(scores: list[tuple[int, float]], n: int, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum) of n words, of which those in `scores`
    (position, score > 0) score so and all others `drift`: one pass, with a stack of
    candidates that are merged when a later one starts no lower and ends higher."""
    stack: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum up to the end
    total, at = 0.0, 0
    for position, score in scores:
        total += drift * (position - at)
        at = position + 1
        start, before = position, total
        total += score
        while True:
            # the nearest candidate that starts at a lower sum
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= before:
                k -= 1
            if k < 0 or stack[k][3] >= total:
                stack.append((start, at, before, total))
                break
            start, before = stack[k][0], stack[k][2]
            del stack[k:]
    return [(start, end, high - low) for start, end, low, high in stack]


def growth(scores: np.ndarray, share: np.ndarray) -> float:
    """The root lambda > 0 of sum(share * exp(lambda * score)) = 1; the mean score is negative."""
    low, high = 0.0, 1.0
    value = lambda x: float(np.sum(share * np.exp(np.minimum(x * scores, 700.0))))
    while value(high) < 1:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 1 else (low, middle)
    return high


def logistic(x: np.ndarray, ones: np.ndarray, all_: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of a ridge logistic regression on grouped points, by Newton steps."""
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (ones - all_ * p) - 1e-3 * beta
        hessian = (design * (all_ * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _fold(doc_id):
    return F.crc32(doc_id.cast("string")) % FOLDS


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the training fold: at most MOST_LABELS rows."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.filter(_fold(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELS)


def _count(batches):
    counts: Counter[str] = Counter()
    for b in batches:
        for text, toxic in zip(b["text"], b["toxic"], strict=True):
            mark = "1" if toxic else "0"
            counts.update(mark + w for w in set(words_of(text)))
        if len(counts) > 500_000:
            yield {"word": [*counts], "n": [*counts.values()]}
            counts.clear()
    yield {"word": [*counts], "n": [*counts.values()]}


def learn(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float] | None:
    """Scores of toxic words, and lambda; None if they can't be learned."""
    marked = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("text", "toxic")
    # at most MOST_LABELS documents; whatever task holds a copy, it counts once
    once = marked.withColumn("digest", F.sha2(F.coalesce("text", F.lit("")), 256)).dropDuplicates(["digest", "toxic"])
    marks = map_batches(once.select("text", "toxic"), _count, {"word": "string", "n": "long"})
    word, toxic = F.substring("word", 2, 1 << 30), F.substring("word", 1, 1) == "1"
    counts = cut(
        marks.groupBy(word.alias("w")).agg(
            F.sum(F.when(toxic, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(toxic, 0).otherwise(F.col("n"))).alias("clean")
        )
    )
    n_toxic, n_clean = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not n_toxic or not n_clean:
        return None
    words = counts.count()
    prior = F.lit(BASE_PRIOR) + F.lit(SHARED_PRIOR / (n_toxic + n_clean)) * (F.col("toxic") + F.col("clean"))
    whole = BASE_PRIOR * words + SHARED_PRIOR
    odds = lambda y, n: F.log((y + prior) / (F.lit(n + whole) - y - prior))
    delta = odds(F.col("toxic"), n_toxic) - odds(F.col("clean"), n_clean)
    deviation = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    strong = counts.withColumn("score", delta - F.lit(DEVIATIONS) * deviation).filter((F.col("toxic") >= LEAST_TOXIC) & (F.col("score") > LEAST_SCORE))
    # only the words that score come to the driver, and at most so many
    rows = strong.orderBy(F.desc("score"), "w").limit(MOST_WORDS).select("w", "score", "clean").collect()
    if not rows:
        return None
    scores = {row["w"]: float(row["score"]) for row in rows}
    # a word that no clean text has is taken to occur there half a time
    share = np.array([max(row["clean"], 0.5) for row in rows]) / n_clean
    rate = growth(np.array([*scores.values(), DRIFT]), np.append(share, 1 - share.sum())) if share.sum() < 1 and (share * np.array([*scores.values()])).sum() + DRIFT * (1 - share.sum()) < 0 else 1.0
    return scores, rate


def find_segments(docs: DataFrame, scores: dict[str, float], rate: float, significant: float) -> DataFrame:
    """Per row: doc_id, n_words, total (sum of the significant segments' normalised sums, or
    the best one's), and the significant segments' starts and ends in words."""
    columns = {"doc_id": "long", "n_words": "long", "total": "double", "seg_start": "array<int>", "seg_end": "array<int>"}

    def kernel(batches):
        for b in batches:
            out = {name: [] for name in columns} | {"doc_id": b["doc_id"]}
            for text in b["text"]:
                words = words_of(text)
                found = segments([(i, scores[w]) for i, w in enumerate(words) if w in scores], len(words))
                less = math.log(max(len(words), 1))
                values = [(rate * s - less, start, end) for start, end, s in found]
                kept = [v for v in values if v[0] > significant]
                total = sum(v for v, _, _ in kept) if kept else max((v for v, _, _ in values), default=LEAST_TOTAL)
                out["n_words"].append(len(words))
                out["total"].append(max(total, LEAST_TOTAL))
                out["seg_start"].append([start for _, start, _ in kept])
                out["seg_end"].append([end for _, _, end in kept])
            yield out

    return map_batches(docs.select("doc_id", "text"), kernel, columns)


def score_toxicity(docs: DataFrame, labels: DataFrame, significant: float = 0.0) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score, predicted, n_segments."""
    train = cut(training_labels(labels))
    model = learn(docs, train)
    held_out = F.coalesce(_fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    if model is None:
        return docs.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).alias("n_segments"))
    found = cut(find_segments(docs, *model, significant))
    bins = F.round(F.col("total") / STEP).cast("int")
    # a grid of rounded totals, cut off at 40 above
    points = found.join(F.broadcast(train), "doc_id").groupBy(F.least(bins, F.lit(int(40 / STEP))).alias("bin")).agg(F.sum("toxic").alias("ones"), F.count("*").alias("n")).collect()
    grid = sorted((p["bin"] * STEP, p["ones"], p["n"]) for p in points)
    x, ones, n = (np.array(c, float) for c in zip(*grid, strict=True))
    a, b = logistic(x, ones, n)
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.least(F.col("total"), F.lit(40.0)))))
    return found.select("doc_id", held_out, score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.size("seg_start").alias("n_segments"))
