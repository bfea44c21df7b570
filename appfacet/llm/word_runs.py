"""Periodic runs of words, found in a grammar of the text, and the text without their repeats.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) of at
least max(LEAST_LENGTH, LEAST_TIMES * q) words that no neighbouring word extends keeping q.
Re-Pair turns the word numbers of a text into a grammar: the most frequent pair of symbols, of
equally frequent ones the oldest, becomes a symbol of its own until no pair is left twice, and
what remains is halved into symbols used once. A run has one smallest symbol it lies in, and
crosses the boundary of that symbol's two parts. So the runs that cross a boundary are computed
once for each symbol, moved to all positions where the symbol is derived, and of intervals of
one period those inside others go.

Words that can't lie in a run are left out of the grammar: any LEAST_LENGTH / LEAST_TIMES
consecutive words of a run occur again in it, as a period is no longer than a third of the run.
Those pieces are compared by 64-bit hashes, where equal hashes of different pieces only cost time;
a run itself is always made of equal words.

Defined results: a null or empty text and one without words have no runs and an empty collapsed
text; words without runs are joined by one space; runs may overlap, and each drops the words after
its own first period; rows are handled one by one, so equal rows, null ids and ties give a row
each; columns beyond doc_id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import map_batches, mix, words_of

LEAST_LENGTH, LEAST_TIMES = 24, 3
PIECE = LEAST_LENGTH // LEAST_TIMES
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def number_words(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, from 0 in order of appearance."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def repeating_pieces(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for the piece of PIECE words at each position, and whether it occurs twice or more."""
    n = len(ids) - PIECE + 1
    hashes = np.zeros(n, np.uint64)
    for k in range(PIECE):
        hashes = mix(hashes * MULTIPLIER + ids[k : k + n].astype(np.uint64) + np.uint64(1))
    _, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
    return number, count[number] > 1


def stretches(again: np.ndarray) -> list[tuple[int, int]]:
    """The spans of words, LEAST_LENGTH or longer, that repeating pieces cover without a gap."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], again.view(np.int8), [0]])))
    spans = [(int(a), int(b) + PIECE - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    apart: list[tuple[int, int]] = []
    for a, b in spans:
        if b - a < LEAST_LENGTH:
            continue
        if apart and a < apart[-1][1]:
            apart[-1] = apart[-1][0], b
        else:
            apart.append((a, b))
    return apart


class Grammar:
    """Symbols below `base` are words; the others have two parts, made before them.

    `first` is a position where a symbol is derived, so that its words can be read in the text.
    """

    def __init__(self, ids: np.ndarray, spans: list[tuple[int, int]]):
        self.base = int(ids.max()) + 1 if len(ids) else 1
        self.parts: list[tuple[int, int]] = []
        self.sizes: list[int] = []
        self.first: list[int] = []
        self.tops: list[tuple[int, int]] = []
        self._pair_up(ids, spans)

    def size(self, symbol: int) -> int:
        return self.sizes[symbol - self.base] if symbol >= self.base else 1

    def _symbol(self, left: int, right: int, at: int) -> int:
        self.parts.append((left, right))
        self.sizes.append(self.size(left) + self.size(right))
        self.first.append(at)
        return self.base + len(self.parts) - 1

    def _pair_up(self, ids: np.ndarray, spans: list[tuple[int, int]]) -> None:
        symbols = ids.tolist()
        following = [*range(1, len(symbols) + 1)]  # the position of the next symbol
        before = [*range(-1, len(symbols) - 1)]
        for a, b in spans:
            before[a], following[b - 1] = -1, -1
        places: dict[tuple[int, int], list[int]] = {}
        for a, b in spans:
            for i in range(a, b - 1):
                places.setdefault((symbols[i], symbols[i + 1]), []).append(i)
        queue = [(-len(at), age, pair) for age, (pair, at) in enumerate(places.items()) if len(at) > 1]
        heapq.heapify(queue)
        age = len(places)
        while queue:
            bound, born, pair = heapq.heappop(queue)
            left, right = pair
            found, still, last = [], [], -1
            for i in places[pair]:  # in order; places may be gone, and overlap if both parts are equal
                j = following[i] if symbols[i] == left else -1
                if j >= 0 and symbols[j] == right:
                    still.append(i)
                    if i > last:
                        found.append(i)
                        last = j
            if len(found) < 2:
                del places[pair]
                continue
            if len(found) < -bound:  # counts only fall, so the top of the queue with its true count is the most frequent pair
                places[pair] = still
                heapq.heappush(queue, (-len(found), born, pair))
                continue
            del places[pair]
            new = self._symbol(left, right, found[0])
            fresh: dict[tuple[int, int], list[int]] = {}
            for i in found:
                j = following[i]
                after = following[j]
                symbols[i], symbols[j], following[i] = new, -1, after
                if after >= 0:
                    before[after] = i
            for i in found:
                if before[i] >= 0:
                    fresh.setdefault((symbols[before[i]], new), []).append(before[i])
                if following[i] >= 0 and symbols[following[i]] != new:
                    fresh.setdefault((new, symbols[following[i]]), []).append(i)
            for pair, at in fresh.items():
                if len(at) > 1:
                    places[pair] = at
                    heapq.heappush(queue, (-len(at), age, pair))
                    age += 1
        for a, _ in spans:
            row, i = [], a
            while i >= 0:
                row.append((symbols[i], i))
                i = following[i]
            while len(row) > 1:  # halves, so that the tree stays flat
                paired = [(self._symbol(x[0], y[0], x[1]), x[1]) for x, y in zip(row[::2], row[1::2], strict=False)]
                row = paired + row[len(row) - len(row) % 2 :]
            self.tops.append(row[0])

    def positions(self) -> dict[int, np.ndarray]:
        """Where each symbol long enough for a run is derived, from the tops downwards."""
        at: dict[int, list] = {}
        for symbol, i in self.tops:
            at.setdefault(symbol, []).append(np.array([i]))
        out = {}
        for k in range(len(self.parts) - 1, -1, -1):
            symbol = self.base + k
            if symbol in at:
                out[symbol] = here = np.concatenate(at.pop(symbol))
                left, right = self.parts[k]
                for part, shift in ((left, 0), (right, self.size(left))):
                    if self.size(part) >= LEAST_LENGTH:
                        at.setdefault(part, []).append(here + shift)
        return out


def equal_ahead(ids: np.ndarray, i: int, j: int, end: int) -> int:
    """How many words from i on equal those from j on (i < j), up to `end`."""
    step, at = 16, 0
    while j + at < end:
        n = min(step, end - j - at)
        differ = ids[i + at : i + at + n] != ids[j + at : j + at + n]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + n, 2 * step
    return end - j


def equal_back(ids: np.ndarray, i: int, j: int, start: int) -> int:
    """How many words before i equal those before j (i < j), down to `start`."""
    step, at = 16, 0
    while i - at > start:
        n = min(step, i - at - start)
        differ = (ids[i - at - n : i - at] != ids[j - at - n : j - at])[::-1]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + n, 2 * step
    return i - start


def crossing_runs(ids: np.ndarray, places: dict[int, np.ndarray], number: np.ndarray, start: int, middle: int, end: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs within [start, end) that cross `middle`.

    A run that does holds the piece at `middle` or the one before it, and that piece again one
    period before or after.
    """
    found: list[tuple[int, int, int]] = []
    longest = (end - start) // LEAST_TIMES
    for anchor in (middle, middle - PIECE):
        if anchor < start or anchor + PIECE > end:
            continue
        same = places[number[anchor]]
        low, high = np.searchsorted(same, [max(start, anchor - longest), min(end - PIECE, anchor + longest) + 1])
        near = same[low:high]
        near = near[near != anchor]
        i, j = np.minimum(near, anchor), np.maximum(near, anchor)
        periods = j - i
        likely = np.ones(len(near), bool)
        for share in (1, 2):
            # twice the period and more is equal one period on, around i: so is the piece at one of these distances
            shift = np.maximum(periods - PIECE, 0) // share
            low, high = np.maximum(i - shift, start), np.minimum(j + shift, end - PIECE)
            likely &= (number[low] == number[low + periods]) | (number[high - periods] == number[high])
        for k in np.flatnonzero(likely)[np.argsort(periods[likely], kind="stable")]:
            a, b, period = int(i[k]), int(j[k]), int(periods[k])
            # a multiple of a period that holds over both pieces isn't the smallest one there
            if any(period % q == 0 and first <= a and b + PIECE <= last for first, last, q in found):
                continue
            a, b = a - equal_back(ids, a, b, start), b + equal_ahead(ids, a, b, end)
            if a < middle < b and b - a >= max(LEAST_LENGTH, LEAST_TIMES * period):
                found.append((a, b, period))
    return [*dict.fromkeys(found)]


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if len(ids) < LEAST_LENGTH:
        return []
    number, again = repeating_pieces(ids)
    spans = stretches(again)
    if not spans:
        return []
    order = np.argsort(number, kind="stable")
    cuts = np.flatnonzero(np.diff(number[order])) + 1
    places = {int(number[at[0]]): at for at in np.split(order, cuts)}
    grammar = Grammar(ids, spans)
    ends: dict[int, set] = {}
    for symbol, at in grammar.positions().items():
        k = symbol - grammar.base
        first, size = grammar.first[k], grammar.sizes[k]
        if size < LEAST_LENGTH:
            continue
        middle = first + grammar.size(grammar.parts[k][0])
        for a, b, period in crossing_runs(ids, places, number, first, middle, first + size):
            ends.setdefault(period, set()).update(zip((at + (a - first)).tolist(), (at + (b - first)).tolist(), strict=True))
    return maximal_runs(ends)


def maximal_runs(ends: dict[int, set]) -> list[tuple[int, int, int]]:
    """Of intervals with one period those inside no other, and no multiples of a smaller period."""
    kept: dict[int, list[tuple[int, int]]] = {}
    for period in sorted(ends):
        outer: list[tuple[int, int]] = []
        for a, b in sorted(ends[period], key=lambda x: (x[0], -x[1])):
            if not outer or b > outer[-1][1]:
                outer.append((a, b))
        smaller = [kept[q] for q in kept if period % q == 0]
        outer = [x for x in outer if not any(_holds(runs, x) for runs in smaller)]
        if outer:
            kept[period] = outer
    return sorted((a, b - a, q) for q, runs in kept.items() for a, b in runs)


def _holds(runs: list[tuple[int, int]], inner: tuple[int, int]) -> bool:
    """Whether one of the runs, sorted by start and end alike, holds the interval."""
    at = bisect_left(runs, (inner[0] + 1, 0)) - 1
    return at >= 0 and runs[at][1] >= inner[1]


def without_repeats(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those that no run contains after its first period."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:n]) == 0


def _kernel(batches):
    for b in batches:
        out = {"doc_id": b["doc_id"], "n_words": [], "starts": [], "lengths": [], "periods": [], "collapsed": []}
        for text in b["text"]:
            words = words_of(text)
            runs = find_runs(number_words(words))
            out["n_words"].append(len(words))
            for name, values in zip(("starts", "lengths", "periods"), zip(*runs, strict=True) if runs else ((), (), ()), strict=True):
                out[name].append([*values])
            if runs:
                words = [words[i] for i in np.flatnonzero(without_repeats(len(words), runs))]
            out["collapsed"].append(b" ".join(words).decode())
        yield out


def collapse_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of `docs` (doc_id, text)."""
    columns = {"doc_id": "long", "n_words": "long", "starts": "array<long>", "lengths": "array<long>", "periods": "array<long>", "collapsed": "string"}
    found = map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _kernel, columns)
    runs = F.transform(F.arrays_zip("starts", "lengths", "periods"), lambda r: F.struct(r.starts.alias("start"), r.lengths.alias("length"), r.periods.alias("period")))
    return found.select("doc_id", "n_words", runs.alias("runs"), "collapsed")
