"""Best-fit packing planned over a histogram of lengths.

Documents become token pieces of at most `capacity`. Only the histogram of their lengths
(at most `capacity` rows) reaches the planner, which fits lengths from long to short into
the fullest sequence that still takes them, whole counts at a time. The plan is a list of
runs: so many pieces of one length, from one rank on, go to consecutive sequences at one
offset. Pieces take their places by their rank within their length; ranks come from
counts per bucket, so no length is numbered in one task.

Defined results: a null or empty text is one piece that holds the end token alone;
repeated rows each get places of their own; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from functools import lru_cache
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from appfacet.llm.common import cut, map_arrays, map_batches

END_ID = 1
BUCKETS = 128
CHUNK = 128
MOST_WORDS = 900_000
#: words that go to the library as one text
TOGETHER = 1024
# fixed values: the vocabulary's split pattern where all characters are Latin
LATIN_WORDS = re.compile(r"[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)|\d|(?:[^\w\s]|_)+")
OTHER_THAN_LATIN = re.compile("[\x1c-\x1f\x85\xb2\xb3\xb9\xbc-\xbeİɐ-\U0010ffff]")
_PIECES = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}


class WordEncoder:
    """Ids of whole texts, from the library's ids of their words.

    No word holds a space, so a Latin text's ids are, after lower-casing, those of its
    stretches between spaces in a row, and a stretch's those of its words. Both are kept;
    new words are encoded many at once, and told apart by the library's word numbers. Other
    texts, and those with marks that could be special tokens, go to the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.library.encode_batch(texts, add_special_tokens=False)]

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.library.encode(" ".join(words), add_special_tokens=False)
        numbers = np.array(found.word_ids, np.int64)
        if not np.array_equal(np.unique(numbers), np.arange(len(words))):  # the library splits otherwise
            return self._library(words)
        ids, starts = np.array(found.ids, "<u4").tobytes(), (4 * np.searchsorted(numbers, np.arange(len(words) + 1))).tolist()
        return [ids[start:end] for start, end in pairwise(starts)]

    def _learn(self, stretches: set[str]) -> None:
        parts = {stretch: LATIN_WORDS.findall(stretch) for stretch in stretches}
        new = [*set().union(*parts.values()).difference(self.words)]
        for at in range(0, len(new), TOGETHER):
            self.words.update(zip(new[at : at + TOGETHER], self._each(new[at : at + TOGETHER]), strict=True))
        ids = self.words.__getitem__
        self.words.update({stretch: b"".join(map(ids, words)) for stretch, words in parts.items() if stretch not in self.words})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit little-endian numbers."""
        if len(self.words) > MOST_WORDS:  # a task's memory; words are encoded anew when needed
            self.words.clear()
        split = [None if "<|" in text or OTHER_THAN_LATIN.search(text) else text.lower().split() for text in texts]
        self._learn(set().union(*(x for x in split if x)).difference(self.words))
        ids = self.words.__getitem__
        return [self._library([text])[0] if words is None else b"".join(map(ids, words)) for text, words in zip(texts, split, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary."""
    return WordEncoder(path)


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each row's ids, the end id included."""
    end = np.array([END_ID], "<u4").tobytes()

    def kernel(batches):
        words = encoder(vocabulary)
        for b in batches:
            for at in range(0, len(b["text"]), CHUNK):
                out = {name: [] for name in _PIECES}
                texts = [text or "" for text in b["text"][at : at + CHUNK]]
                for doc_id, ids in zip(b["doc_id"][at : at + CHUNK], words.encode(texts), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        for name, value in zip(_PIECES, (doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            out[name].append(value)
                yield out

    return map_batches(docs.select("doc_id", "text"), kernel, _PIECES)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first_rank, count, per_sequence, first_sequence, offset): rank r takes
    sequence first_sequence + (r - first_rank) // per_sequence, slot (r - first_rank) % per_sequence.

    Best fit over counts: the sequences with the least room that still take the length are
    filled as full as it goes, then the next; new ones are opened when none has room.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, count)
    rooms: list[int] = []
    runs, opened = [], 0

    def leave(left: int, first: int, count: int) -> None:
        if left and count:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, count))

    for length in sorted(histogram, reverse=True):
        rank, todo = 0, histogram[length]
        while todo:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, count = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first, count = capacity, opened, -(-todo // (capacity // length))
                opened += count
            each = left // length
            full = min(count, todo // each)
            if full:
                runs.append((length, rank, full * each, each, first, capacity - left))
                leave(left - each * length, first, full)
                rank, todo = rank + full * each, todo - full * each
            rest = 0
            if full < count and todo:
                rest, some = 1, min(todo, each)
                runs.append((length, rank, some, some, first + full, capacity - left))
                leave(left - some * length, first + full, 1)
                rank, todo = rank + some, todo - some
            leave(left, first + full + rest, count - full - rest)
    return runs


def ranked(pieces: DataFrame) -> DataFrame:
    """`pieces` with their rank within their length, from 0."""
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int"))
    counts = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    bases = counts.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32"))
    return keyed.withColumn("nth", within - 1).join(bases, ["length", "bucket"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = cut(token_pieces(docs, vocabulary, capacity))
    # at most `capacity` lengths, whatever the corpus
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = np.array(plan(histogram, capacity), np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    columns = _PIECES | {"sequence_id": "long", "offset": "long"}

    def place(batches):
        # runs are sorted by length, then rank: the last one at or before a piece is its own
        starts = runs[:, 0].astype(np.float64) * 2.0**40 + runs[:, 1]
        for b in batches:
            at = np.searchsorted(starts, b["length"].astype(np.float64) * 2.0**40 + b["rank"], side="right") - 1
            nth = b["rank"] - runs[at, 1]
            yield b | {"sequence_id": runs[at, 4] + nth // runs[at, 3], "offset": runs[at, 5] + nth % runs[at, 3] * b["length"]}

    placed = map_arrays(ranked(pieces).withColumn("null_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("long"))), place, columns | {"null_id": "boolean"})
    return placed.select(F.when(~F.col("null_id"), F.col("doc_id")).alias("doc_id"), *[c for c in columns if c != "doc_id"])
