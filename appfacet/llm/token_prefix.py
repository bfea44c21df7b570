"""Token counts of every prefix of a text, by dynamic programming over prefixes.

Byte-pair encodings have a prefix property: the encoding of a prefix is the encoding of
a shorter prefix plus one last token, and a token may follow another exactly when the two
together encode as themselves. So the count of each prefix of a piece (a run between the
tokenizer's split points) follows from shorter ones: count[i] = count[i - len(t)] + 1 for
the one token t that may stand last. Tables of pieces are kept per task, and a text's
counts are sums over its pieces, so budget and truncation questions need no encoding.

Defined results: a null text counts as empty: no tokens; the special string inside a text
is one token, as the library has it; repeated rows each get a row.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import map_batches

# fixed value: the split pattern of the byte-level vocabulary
SPLIT = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
MOST_STATES, LONG_PIECE = 1_000_000, 64
# the same split where all characters are Latin, for the standard library's faster matcher
LATIN_SPLIT = re.compile(r" ?[^\W\d_]+|'(?:s|t|re|ve|m|ll|d)| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
OTHER_THAN_LATIN = re.compile("[\x1c-\x1f\x85\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")
WHITE = regex.compile(r"\p{White_Space}+")


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in the vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Counts of all prefixes for one byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        code = lambda token: bytes(letters[c] for c in token)
        self.ids = {code(t): i for t, i in spec["model"]["vocab"].items()}
        self.longest = max(map(len, self.ids))
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for a, b in merges:
            left, right = self.ids[code(a)], self.ids[code(b)]
            whole = self.ids[code(a) + code(b)]
            self.merged[left, right] = whole
            self.halves[whole] = (left, right)
        # a token's id is its merge's rank: earlier merges have smaller ids
        if list(self.merged.values()) != sorted(self.merged.values()):
            raise ValueError("the ids of the vocabulary don't follow the order of its merges")
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.follows: dict[tuple[int, int], bool] = {}
        self.states: dict[bytes, tuple[int, int]] = {}
        self.totals = _Totals(self)

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether two tokens side by side stay as they are.

        Undo merges from the latest on; if the tokens that then touch have a merge that
        ranks before those undone, it would have come first and bridged the border.
        """
        undone = 1 << 60
        while True:
            bridge = self.merged.get((left, right))
            if bridge is not None and bridge < undone:
                return False
            inner, outer = self.halves.get(left), self.halves.get(right)
            if inner is None and outer is None:
                return True
            if inner is not None and (outer is None or left > right):
                undone, left = left, inner[1]
            else:
                # of equal ranks the left one merges first, so a bridge of the same rank would win
                undone, right = right + 1, outer[0]

    def byte_table(self, data: bytes) -> list[int]:
        """Tokens of data[:i] for every i; states of short prefixes are kept for later pieces."""
        ids, follows, states = self.ids, self.follows, self.states
        counts, lasts = [0], [-1]
        for end in range(1, len(data) + 1):
            known = states.get(data[:end]) if end <= LONG_PIECE else None
            if known is None:
                for at in range(max(0, end - self.longest), end):
                    token = ids.get(data[at:end])
                    if token is None:
                        continue
                    if (last := lasts[at]) >= 0:
                        fits = follows.get((last, token))
                        if fits is None:
                            fits = follows[last, token] = self._may_follow(last, token)
                        if not fits:
                            continue
                    known = counts[at] + 1, token
                    break
                if end <= LONG_PIECE:
                    states[data[:end]] = known
            counts.append(known[0])
            lasts.append(known[1])
        return counts

    def last_state(self, data: bytes) -> tuple[int, int]:
        """Token count and last token of `data`, by way of the few prefixes it depends on."""
        if not data:
            return 0, -1
        known = self.states.get(data)
        if known is not None:
            return known
        if len(data) > LONG_PIECE:
            return self.byte_table(data)[-1], -1
        ids, follows, end = self.ids, self.follows, len(data)
        for at in range(end):
            token = ids.get(data[at:])
            if token is None:
                continue
            count, last = self.last_state(data[:at])
            if last >= 0:
                fits = follows.get((last, token))
                if fits is None:
                    fits = follows[last, token] = self._may_follow(last, token)
                if not fits:
                    continue
            known = self.states[data] = count + 1, token
            return known
        raise ValueError("the vocabulary lacks a byte")

    def table(self, piece: str) -> list[int]:
        """Tokens of piece[:i] for every code point i, the piece standing alone."""
        counts = self.byte_table(piece.encode())
        if len(counts) == len(piece) + 1:
            return counts
        return [counts[end] for end in accumulate((len(c.encode()) for c in piece), initial=0)]

    def pieces(self, text: str) -> list[str]:
        if self.special_split is None or not any(s in text for s in self.special):
            return (SPLIT if OTHER_THAN_LATIN.search(text) else LATIN_SPLIT).findall(text)
        out: list[str] = []
        for part in self.special_split.split(text):
            out += [part] if part in self.special else SPLIT.findall(part)
        return out

    def count(self, text: str) -> int:
        return sum(map(self.totals.__getitem__, self.pieces(text)))

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of text[:i] for every code point i; entry 0 is 0.

        A prefix that cuts a piece is split as a text of its own: white space at its end
        is one piece, a cut contraction is an apostrophe and letters, a cut special
        string joins the punctuation before it.
        """
        out, base, run, at, last = [0], 0, None, 0, ("", 0)
        for piece in self.pieces(text):
            total = self.totals[piece]
            if piece in self.special:
                out += [last[1] + self.count(last[0] + piece[:i]) for i in range(1, len(piece))] + [base + total]
                last, run = ("", base + total), None
            else:
                if WHITE.match(piece) and run is None:
                    run = (at, base, self.table(WHITE.match(text, at).group()))
                counts = self.table(piece)
                contraction = piece[0] == "'" and piece[1:].isalpha()
                for i in range(1, len(piece) + 1):
                    if run and WHITE.match(piece, i - 1):
                        out.append(run[1] + run[2][at + i - run[0]])
                    elif contraction and i < len(piece):
                        out.append(base + self.count(piece[:i]))
                    else:
                        out.append(base + counts[i])
                if not WHITE.match(piece, len(piece) - 1):
                    run = None
                last = (piece, base)
            base += total
            at += len(piece)
        return out

    def count_within(self, text: str, limit: int) -> tuple[int, int]:
        """Tokens of `text`, and code points of its longest prefix with at most `limit` tokens.

        Totals at the ends of pieces grow, so the prefix ends in the pieces after the last
        end within the limit; only those are looked into, up to the first that begins
        beyond the limit outside white space.
        """
        pieces = self.pieces(text)
        counts = [*map(self.totals.__getitem__, pieces)]
        if (total := sum(counts)) <= limit:
            return total, len(text)
        totals = list(accumulate(counts, initial=0))
        inside = max(0, bisect_right(totals, limit) - 1)
        first = max(0, inside - 1)
        while first and WHITE.match(pieces[first - 1], len(pieces[first - 1]) - 1):
            first -= 1
        stop = inside + 1
        while stop < len(pieces) and (totals[stop] <= limit or WHITE.match(pieces[stop - 1], len(pieces[stop - 1]) - 1)):
            stop += 1
        at = sum(map(len, pieces[:first]))
        counts = self.prefix_counts("".join(pieces[first : stop + 1]))
        return total, at + max((i for i, n in enumerate(counts) if totals[first] + n <= limit), default=0)


class _Totals(dict):
    """Tokens of a whole piece, from its table."""

    def __init__(self, counter: PrefixCounter) -> None:
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        if len(self.counter.states) > MOST_STATES:  # a task's memory; states are made anew when needed
            self.counter.states.clear()
            self.clear()
        n = 1 if piece in self.counter.special else self.counter.last_state(piece.encode())[0]
        if len(piece) <= LONG_PIECE:
            self[piece] = n
        return n


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    """One counter per Python worker and vocabulary."""
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, tables: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit, fit_chars (code points of the longest
    prefix within `limit` tokens), and with `tables` the tokens of every prefix."""
    columns = {"doc_id": "long", "n_bytes": "long", "n_tokens": "long", "over_limit": "boolean", "fit_chars": "long"}
    if tables:
        columns["prefix_tokens"] = "array<int>"

    def kernel(batches):
        prefix = counter(vocabulary)
        for b in batches:
            out = {name: [] for name in columns} | {"doc_id": b["doc_id"]}
            for text in b["text"]:
                text = text or ""
                n, fit = prefix.count_within(text, limit)
                out["n_bytes"].append(len(text.encode()))
                out["n_tokens"].append(n)
                out["over_limit"].append(n > limit)
                out["fit_chars"].append(fit)
                if tables:
                    out["prefix_tokens"].append(prefix.prefix_counts(text))
            yield out

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), kernel, columns)
