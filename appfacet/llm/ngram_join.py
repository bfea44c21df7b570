"""N-gram Jaccard join with skipping by set relations, and its connected components.

Sets of word shingles are joined by inverted lists of their prefixes: under one order of
all shingles (those found often by any task last, else by hash) two sets above the
threshold share a shingle among the first |x| - ceil(t|x|) + 1 of each. Equal sets are
one vertex from the start.

Index level: a list is read in blocks of one size class, with the positions of its entries.
Only neighbouring classes meet, and an entry whose position bounds the overlap too low is
skipped. Answer level: the first set of a block, which has the fewest rare shingles and is
thus most like the others, is the pivot that all entries are compared with. Sets that a
pivot's answers hold need no comparison with each other. Only sets that the pivot leaves
out are compared with the pivot's other entries, in blocks: bitmaps of the sets,
folded to one width, bound the symmetric difference from below and skip nearly all of these;
the rest are computed exactly from the texts, unless they are connected already.

Every linked pair meets in a list, both have the earlier pivot of their classes there in
common, and thus are in one component or compared. Sets are told apart by 64-bit hashes.

Defined results: a null text, or one without words, has the empty set and is its own
component; fewer words than a shingle are one shingle; rows of one id each get a row, with
the smallest id reachable from any; a null id belongs to a component and never names it,
unless all ids there are null; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import cut, free_name, hash64, hash_words, map_arrays, map_batches, mix
from appfacet.llm.graph import components, id_filter, passes

SHINGLE = 5
#: a link needs NUMERATOR / DENOMINATOR of the union in common
NUMERATOR, DENOMINATOR = 3, 4
#: shingles that a task finds in this many sets are counted across tasks
LOCALLY_OFTEN = 4
OFTEN = 32
#: bound of the shingles that are ordered last, the most frequent ones
MOST_OFTEN = 1 << 18
FLUSH = 4_000_000
CHUNK = 2048
COLD_BITS, SIZE_BITS = 11, 26
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _classes() -> np.ndarray:
    """Lower ends of size classes; sizes within the threshold are in one class or neighbours."""
    ends = [1]
    while ends[-1] < 1 << SIZE_BITS:
        ends.append(-(-ends[-1] * DENOMINATOR // NUMERATOR))
    return np.array(ends, np.int64)


CLASSES = _classes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; A-Z are lower-cased."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < SHINGLE:
        return np.array([hash64(b" ".join(words))], np.uint64)
    hashes = hash_words(words)
    last = len(words) - SHINGLE + 1
    out = hashes[:last]
    for k in range(1, SHINGLE):
        out = mix(out * MULTIPLIER + hashes[k : k + last])
    return np.unique(out)


def set_id(tokens: np.ndarray) -> int:
    return int(np.array(hash64(tokens.tobytes()), np.uint64).astype(np.int64))


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens on each of 2^k >= n bits; wider maps fold onto narrower ones."""
    width = max(64, 1 << (len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differ(a: int, a_width: int, b: int, b_width: int) -> int:
    """Least symmetric difference of two sets that their bitmaps allow."""
    while a_width != b_width:
        if a_width < b_width:
            a, a_width, b, b_width = b, b_width, a, a_width
        a_width //= 2
        a = (a ^ a >> a_width) & ((1 << a_width) - 1)
    return (a ^ b).bit_count()


def as_number(bits: bytes) -> int:
    return int.from_bytes(bits, "little")


_SCAN = {"kind": "int", "row_key": "long", "doc_id": "long", "n": "long", "v": "long", "bits": "binary"}


def _scan(batches):
    """Kind 0: a row per document. Kind 1: shingles in many sets of this task, with counts."""
    held, size, seen = [], 0, set()

    def often():
        tokens, counts = np.unique(np.concatenate(held), return_counts=True)
        tokens, counts = tokens[counts >= LOCALLY_OFTEN].view(np.int64), counts[counts >= LOCALLY_OFTEN]
        none = [None] * len(tokens)
        return {"kind": np.ones(len(tokens), np.int32), "row_key": none, "doc_id": none, "n": counts, "v": tokens, "bits": none}

    for b in batches:
        out = {name: [] for name in _SCAN} | {"row_key": b["row_key"], "doc_id": b["doc_id"]}
        for text in b["text"]:
            tokens = shingles(text)
            v = set_id(tokens)
            out["kind"].append(0)
            out["n"].append(len(tokens))
            out["v"].append(v)
            out["bits"].append(bitmap(tokens) if v not in seen and len(tokens) else None)
            if v not in seen and len(tokens):
                seen.add(v)
                held.append(tokens)
                size += len(tokens)
        yield out
        if size > FLUSH:
            yield often()
            held, size = [], 0
    if held:
        yield often()


def _postings(often: np.ndarray):
    """Kernel: prefix entries (token, entry, v) of each distinct set of the task, where
    `entry` is the number of rare shingles (capped, for the choice of pivots only), the size
    and the position, from high to low bits."""

    def kernel(batches):
        seen = set()
        for b in batches:
            out = {"token": [], "entry": [], "v": []}
            for text in b["text"]:
                tokens = shingles(text)
                n = len(tokens)
                v = set_id(tokens)
                if not n or v in seen:
                    continue
                if n >= 1 << SIZE_BITS:
                    raise ValueError("a text has more shingles than the lists can number")
                seen.add(v)
                late = np.zeros(n, bool)
                if len(often):
                    at = np.minimum(np.searchsorted(often, tokens), len(often) - 1)
                    late = often[at] == tokens
                prefix = n - -(-n * NUMERATOR // DENOMINATOR) + 1
                first = np.concatenate([tokens[~late], tokens[late]])[:prefix]
                rare = min(int((~late).sum()), (1 << COLD_BITS) - 1)
                out["token"].append(first.view(np.int64))
                out["entry"].append(((rare << SIZE_BITS | n) << SIZE_BITS) + np.arange(prefix, dtype=np.int64))
                out["v"].append(np.full(prefix, v, np.int64))
            if out["v"]:
                yield {name: np.concatenate(x) for name, x in out.items()}

    return kernel


def _meet(batches):
    """Entries of sorted lists with the pivots of their own and the neighbouring size classes.

    The pivots of the list that a batch ends in go on to the next batch, so that a list may
    be of any length.
    """
    mask = (1 << SIZE_BITS) - 1
    token, entry, v = (np.zeros(0, np.int64) for _ in range(3))
    last = None
    for b in batches:
        carried = len(token)
        token, entry, v = np.append(token, b["token"]), np.append(entry, b["entry"]), np.append(v, b["v"])
        new = np.arange(len(token)) >= carried
        # copies of a set come one after the other
        same = np.zeros(len(token), bool)
        same[1:] = (token[1:] == token[:-1]) & (v[1:] == v[:-1])
        if last is not None and carried < len(token):
            same[carried] = (token[carried], v[carried]) == last
        last = (token[-1], v[-1])
        keep = ~same | ~new
        token, entry, v, new = token[keep], entry[keep], v[keep], new[keep]
        size, position = entry >> SIZE_BITS & mask, entry & mask
        kind = np.searchsorted(CLASSES, size, side="right")
        lists = np.cumsum(np.append(True, token[1:] != token[:-1]))
        block = lists * 128 + kind
        keys, first = np.unique(block, return_index=True)
        ys, xs, oks = [], [], []
        for step in (-1, 0, 1):
            at = np.minimum(np.searchsorted(keys, block + step), len(keys) - 1)
            pivot = first[at]
            rows = np.nonzero((keys[at] == block + step) & (pivot < np.arange(len(v))) & new)[0]
            p = pivot[rows]
            small, large = np.minimum(size[rows], size[p]), np.maximum(size[rows], size[p])
            overlap = np.minimum(position[rows], position[p]) + np.minimum(size[rows] - position[rows], size[p] - position[p])
            needs = (NUMERATOR + DENOMINATOR) * overlap >= NUMERATOR * (size[rows] + size[p])
            ys.append(v[rows])
            xs.append(v[p])
            oks.append((small * DENOMINATOR >= large * NUMERATOR) & needs)
        yield {"y": np.concatenate(ys), "x": np.concatenate(xs), "may": np.concatenate(oks).astype(np.int32)}
        ends = first[np.nonzero(keys // 128 == lists[-1])[0]]
        ends = np.sort(ends)
        token, entry, v = token[ends], entry[ends], v[ends]


def _bound(batches):
    """Pairs whose bitmaps let their sets be above the threshold."""
    for b in batches:
        may = []
        for ok, s, t, p, q in zip(b["may"], b["y_n"], b["x_n"], b["y_bits"], b["x_bits"], strict=True):
            if ok:
                least = differ(as_number(p), 8 * len(p), as_number(q), 8 * len(q))
                ok = int((NUMERATOR + DENOMINATOR) * least <= (DENOMINATOR - NUMERATOR) * (s + t))
            may.append(ok)
        yield {"y": b["y"], "x": b["x"], "may": may}


def _texts(bits: np.ndarray):
    def kernel(batches):
        for b in batches:
            sets = np.array([set_id(shingles(text)) for text in b["text"]], np.int64)
            at = np.nonzero(passes(bits, sets))[0] if len(sets) else []
            yield {"v": sets[at], "text": [b["text"][i] for i in at]}

    return kernel


def _exact(batches):
    for b in batches:
        linked, last, ours = [], None, None
        for left, right in zip(b["x_text"], b["y_text"], strict=True):
            if left is not last:
                last, ours = left, shingles(left)
            theirs = shingles(right)
            common = len(np.intersect1d(ours, theirs, assume_unique=True))
            linked.append(DENOMINATOR * common >= NUMERATOR * (len(ours) + len(theirs) - common))
        yield {"y": b["y"], "x": b["x"], "linked": linked}


def _verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(y, x, linked) of the pairs, from the texts of one row for each of their sets."""
    ids = pairs.select(F.col("y").alias("v")).union(pairs.select(F.col("x").alias("v"))).distinct()
    texts = map_batches(docs.select("text"), _texts(id_filter(ids, "v")), {"v": "long", "text": "string"})
    texts = texts.groupBy("v").agg(F.min("text").alias("text"))
    left = pairs.join(texts.select(F.col("v").alias("y"), F.col("text").alias("y_text")), "y")
    both = left.join(texts.select(F.col("v").alias("x"), F.col("text").alias("x_text")), "x")
    return cut(map_batches(both.select("y", "x", "y_text", "x_text"), _exact, {"y": "long", "x": "long", "linked": "boolean"}))


def _leftover(stars: DataFrame, linked: DataFrame, sets: DataFrame, joined: DataFrame) -> DataFrame:
    """(y, x) to compare exactly: sets that a pivot leaves out with the pivot's other entries."""
    known = linked.filter("linked").select("y", "x", F.lit(1).alias("held"))
    entries = stars.select("y", "x").join(known, ["y", "x"], "left")
    sizes = entries.groupBy("x").agg(F.count("*").alias("m"), F.sum(F.when(F.col("held").isNull(), 1).otherwise(0)).alias("u"))
    entries = entries.join(sizes.filter("u > 0 AND m > 1"), "x")
    entries = entries.join(sets.select(F.col("v").alias("y"), "n", "bits"), "y")
    entries = entries.join(joined.select(F.col("id").alias("y"), "component"), "y", "left").withColumn("component", F.coalesce("component", "y"))
    chunks = lambda c: F.ceil(F.col(c) / CHUNK).cast("int")
    here = lambda c, seed: F.pmod(F.xxhash64("y", F.lit(seed)), chunks(c)).cast("int")
    all_ = lambda c: F.explode(F.sequence(F.lit(0), chunks(c) - 1))
    asked = entries.filter("held IS NULL").select("x", "y", "n", "bits", "component", here("u", 1).alias("us"), all_("m").alias("ms"), F.lit(1).alias("asks"))
    other = entries.select("x", "y", "n", "bits", "component", here("m", 2).alias("ms"), all_("u").alias("us"), F.lit(0).alias("asks"))
    groups = asked.unionByName(other).repartition("x", "us", "ms").sortWithinPartitions("x", "us", "ms", "asks", "n")
    return map_batches(groups, _compare, {"y": "long", "x": "long"}).distinct()


def _compare(batches):
    """Chunks of asking sets against chunks of others, by their bitmaps; rows come sorted by
    chunk, others first and by size."""
    chunk, others, sizes, seen = None, [], [], set()
    for b in batches:
        seen.clear()
        for x, us, ms, asks, y, n, bits, component in zip(*(b[c] for c in ("x", "us", "ms", "asks", "y", "n", "bits", "component")), strict=True):
            if (x, us, ms) != chunk:
                chunk, others, sizes = (x, us, ms), [], []
            mine, width = as_number(bits), 8 * len(bits)
            if not asks:
                others.append((y, n, mine, width, component))
                sizes.append(n)
                continue
            low, high = bisect_left(sizes, -(-n * NUMERATOR // DENOMINATOR)), bisect_right(sizes, n * DENOMINATOR // NUMERATOR)
            for z, m, theirs, their_width, of in others[low:high]:
                if of != component and (NUMERATOR + DENOMINATOR) * differ(mine, width, theirs, their_width) <= (DENOMINATOR - NUMERATOR) * (n + m):
                    seen.add((min(y, z), max(y, z)))
        yield {"y": [a for a, _ in seen], "x": [z for _, z in seen]}


def row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, n_shingles, component_id, component (a key that tells
    components apart; null for empty sets), row_key (alike for rows of one id and text)."""
    read = docs.select(row_key().alias("row_key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = cut(map_batches(read, _scan, _SCAN))
    rows = scanned.filter("kind = 0").select("row_key", "doc_id", "n", "v")
    sets = cut(scanned.filter("kind = 0 AND n > 0").groupBy("v").agg(F.max("n").alias("n"), F.max("bits").alias("bits"), F.min("doc_id").alias("least")))
    counted = scanned.filter("kind = 1").groupBy("v").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN)
    frequent = counted.orderBy(F.desc("n"), "v").limit(MOST_OFTEN).select("v").collect()
    often = np.sort(np.array([row["v"] for row in frequent], np.int64).view(np.uint64))
    entries = map_batches(read.select("text"), _postings(often), {"token": "long", "entry": "long", "v": "long"})
    lists = entries.repartition("token").sortWithinPartitions("token", "entry", "v")
    met = map_arrays(lists, _meet, {"y": "long", "x": "long", "may": "int"})
    stars = cut(met.filter("y <> x").groupBy("y", "x").agg(F.min("may").alias("may")))
    sides = lambda c: sets.select(F.col("v").alias(c), F.col("n").alias(f"{c}_n"), F.col("bits").alias(f"{c}_bits"))
    open_ = stars.filter("may = 1").join(sides("y"), "y").join(sides("x"), "x")
    open_ = cut(map_batches(open_.select("y", "x", "may", "y_n", "x_n", "y_bits", "x_bits"), _bound, {"y": "long", "x": "long", "may": "int"}).filter("may = 1"))
    linked = _verify(read, open_.select("y", "x"))
    edges = linked.filter("linked").select(F.col("y").alias("a"), F.col("x").alias("b"))
    joined = components(edges)
    more = cut(_leftover(stars, linked, sets, joined))
    found = _verify(read, more).filter("linked").select(F.col("y").alias("a"), F.col("x").alias("b"))
    joined = components(edges.union(found))
    # components take the smallest document id of their sets
    named = sets.join(joined, sets.v == joined.id, "left").select("v", "least", F.coalesce("component", "v").alias("component"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(names, "component").select("v", "component", "component_id")
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "component", "row_key"]
    alone = rows.filter("n = 0").withColumns({"component": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return rows.filter("n > 0").join(named, "v").select(*columns).union(alone.select(*columns))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, of each component the one with the smallest id; all empty sets stay."""
    found = jaccard_components(docs).withColumn("alone", F.when(F.col("component").isNull(), F.col("row_key")))
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_key")
    first = found.groupBy("component", "alone").agg(F.min(order).alias("first"))
    key, empty, copy = (free_name(docs, c) for c in ("row_key", "empty", "copy"))
    first = first.select(F.col("first.row_key").alias(key), F.col("component").isNull().alias(empty))
    kept = docs.withColumn(key, row_key()).join(first, key)
    # rows that are alike are one document, unless they are empty
    copies = F.when(F.col(empty), F.monotonically_increasing_id()).otherwise(F.lit(0))
    return kept.withColumn(copy, copies).dropDuplicates([key, copy]).drop(key, empty, copy)
