"""Quality rules: per-text counts, and removal of lines that recur across a host's documents.

Lines are normalised (lower case, digits to 0, single spaces) and hashed. A host's line
is frequent when it is carried by more than `min_documents` and more than `share` of the
host's distinct documents, or by more than `most_documents` of them. Documents are told
apart by a hash of all their normalised lines, so that a large group of copies, also of
copies with other digits or spaces, is one document; near copies with other words are
several, as pages with common boilerplate are. Frequent lines are removed; a document that keeps less than `min_left` of its words is depleted and rejected.

Defined results: a null or empty text has zero counts and fails the base rule; a null
host is a host of its own; repeated rows each get a row; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import cut, free_name, hash64, map_batches, rewrite_text, words_of

WHITE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
_DIGITS = bytes.maketrans(b"0123456789", b"0000000000")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_STATS = {"row_key": "long", "doc_id": "long", "host": "string", "content": "long", **dict.fromkeys(COUNTS, "long"), "line_hash": "array<long>", "line_words": "array<int>"}
SALTS = 8
#: a line on more distinct documents of a host is frequent, however large the host is
MOST_DOCUMENTS = 1000


def normal_lines(text: str) -> list[list[bytes]]:
    """Words of each line in lower case, with digits as 0."""
    return [line.split() for line in text.lower().encode().translate(_DIGITS).split(b"\n")]


def line_key(words: list[bytes]) -> int:
    """Signed hash of a normalised line."""
    key = hash64(b" ".join(words))
    return key - (1 << 64) if key >> 63 else key


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    k, x = len(ids), np.fromiter(map(ids.__getitem__, words), np.int64, n)
    pair = x[:-1] * k + x[1:]
    if k >= 2**20:
        pair = np.unique(pair, return_inverse=True)[1]
    _, at, times = np.unique(pair[:-1] * k + x[2:], return_inverse=True, return_counts=True)
    twice = times[at] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : shift + n - 2] |= twice
    return int(inside.sum())


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    if not text:
        return 0, 0, 0, 0, 0
    words = words_of(text)
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def _stats(batches):
    for b in batches:
        out = {name: [] for name in _STATS} | {name: b[name] for name in ("row_key", "doc_id", "host")}
        for text in b["text"]:
            for name, value in zip(COUNTS, text_counts(text), strict=True):
                out[name].append(value)
            lines: dict[int, int] = {}
            content = []
            for words in normal_lines(text or ""):
                if words:
                    content.append(key := line_key(words))
                    lines[key] = lines.get(key, 0) + len(words)
            out["content"].append(line_key([np.array(content, np.int64).tobytes()]))
            out["line_hash"].append(list(lines))
            out["line_words"].append(list(lines.values()))
        yield out


def row_key(host: str) -> Column:
    """Rows with one key are alike: the same id, host and text."""
    return F.xxhash64("doc_id", F.col(host), "text")


def frequent_lines(stats: DataFrame, min_documents: int, share: float, most_documents: int) -> DataFrame:
    """(host, line): lines above the limits, `stats` as made below."""
    lines = stats.select("host", "content", F.explode("line_hash").alias("line"))
    carriers = lines.distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    hosts = stats.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("of"))
    # the totals of the hosts meet only lines that are above the fixed limit
    some = carriers.filter(F.col("n") > min_documents)
    often = (F.col("n") > F.lit(share) * F.col("of")) | (F.col("n") > most_documents)
    return some.join(hosts, some.host.eqNullSafe(hosts.host)).filter(often).select(some.host, "line")


def line_quality(
    docs: DataFrame, host: str = "source", min_documents: int = 30, share: float = 0.01, min_left: float = 0.3, most_documents: int = MOST_DOCUMENTS
) -> DataFrame:
    """Per row of `docs`: doc_id, the counts, base_failed, kept, left_words, and removed_lines
    (hashes of frequent lines in the text, null without any)."""
    read = docs.select(row_key(host).alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), "text")
    stats = cut(map_batches(read, _stats, _STATS).withColumn("row", F.monotonically_increasing_id()))
    frequent = frequent_lines(stats, min_documents, share, most_documents).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    lines = stats.select("row", F.col("host").alias("of_host"), F.explode(F.arrays_zip("line_hash", "line_words")).alias("at"))
    lines = lines.select("row", "of_host", F.col("at.line_hash").alias("hash"), F.col("at.line_words").alias("words"), (F.col("row") % SALTS).cast("int").alias("part"))
    hit = lines.join(frequent, (F.col("hash") == F.col("line")) & F.col("of_host").eqNullSafe(F.col("host")) & (F.col("part") == F.col("salt")))
    removed = hit.groupBy("row").agg(F.sum("words").alias("gone"), F.collect_list("hash").alias("removed_lines"))
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    return (
        stats.drop("line_hash", "line_words", "host", "content")
        .join(removed, "row", "left")
        .select(
            "doc_id",
            *COUNTS,
            base_failed.alias("base_failed"),
            (~base_failed & (left >= F.lit(min_left) * F.col("n_words"))).alias("kept"),
            left.alias("left_words"),
            "removed_lines",
            "row_key",
        )
    )


def without_lines(text: str | None, gone: list[int] | None) -> str | None:
    if not gone:
        return text
    gone = set(gone)
    lines = zip(text.split("\n"), normal_lines(text), strict=True)
    return "\n".join(line for line, words in lines if not words or line_key(words) not in gone)


def accepted(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The rows of `docs` that are kept, with frequent lines taken out of their texts."""
    verdicts = line_quality(docs, host, **limits).filter("kept").groupBy("row_key").agg(F.first("removed_lines").alias("lines"))
    key, lines = free_name(docs, "row_key"), free_name(docs, "removed_lines")
    verdicts = verdicts.select(F.col("row_key").alias(key), F.col("lines").alias(lines))
    return rewrite_text(docs.withColumn(key, row_key(host)).join(verdicts, key).drop(key), without_lines, [lines])
