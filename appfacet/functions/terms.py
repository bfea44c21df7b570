"""Find which literals of a vocabulary occur in a text, in one pass over it.

Testing every literal with ``contains`` reads the text once per literal. Nearly all
literals hold a space, so the index looks for them at the spaces of the text only:
one regular expression stops at each space and captures the longest *tail* (what
follows the first space of a literal). The few literals whose tail was seen are then
confirmed with an exact ``contains``. Any literal present has its tail as a prefix of
the captured one, so none is missed. Literals without a space are tested directly.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .text import as_column, pad_text

# Alternatives per look-ahead class at the root of the pattern (measured best).
ROOT_GROUP = 5
# Up to this many literals without a space are tested inside generated code.
DIRECT_TESTS = 32


def term_literal(term: str, mode: str) -> str:
    """The text to look for: a word is wrapped in spaces, a substring kept raw."""
    if mode == "word":
        return f" {term.strip()} "
    if mode == "substring":
        return term.strip()
    raise ValueError(f"unknown term mode {mode!r}: use 'word' or 'substring'")


def _quote(char: str) -> str:
    return char if char.isalnum() or ord(char) > 127 else "\\" + char


def _prefix_tree(words: Iterable[str]) -> dict:
    root: dict = {}
    for word in words:
        node = root
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}
    return root


def _longest_match(node: dict, group: int | None = None) -> str:
    """Pattern matching the longest word of a prefix tree."""
    branches = [_quote(c) + _longest_match(node[c]) for c in sorted(node) if c]
    if not branches:
        return ""
    if group and len(branches) > group:
        heads = [_quote(c) for c in sorted(node) if c]
        branches = [
            f"(?=[{''.join(heads[i : i + group])}])(?:{'|'.join(branches[i : i + group])})"
            for i in range(0, len(branches), group)
        ]
    body = branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"
    return f"(?:{body})?" if "" in node else body


def _string_array(values: Iterable[str]) -> Column:
    """A literal array of strings, built in one step whatever its length."""
    return F.from_json(F.lit(json.dumps(list(values))), F.lit("array<string>"))


def literal_map(entries: Mapping[str, Iterable[str]]) -> Column:
    """A literal map from strings to arrays of strings, likewise."""
    text = json.dumps({k: list(v) for k, v in entries.items()})
    return F.from_json(F.lit(text), F.lit("map<string, array<string>>"))


class TermIndex:
    """Literals with the labels each one stands for."""

    def __init__(self, labels_by_literal: Mapping[str, Iterable[str]]):
        self.labels = {t: tuple(dict.fromkeys(ls)) for t, ls in labels_by_literal.items()}
        if "" in self.labels:
            raise ValueError("an empty term would match every text")
        self.spaced = [t for t in self.labels if " " in t]
        self.solid = [t for t in self.labels if " " not in t]
        # Space at either end of a literal only occurs in stripped and padded text.
        self.needs_padding = any(t != t.strip() for t in self.labels)
        tails: dict[str, list[str]] = {}
        for literal in self.spaced:
            tails.setdefault(literal.split(" ", 1)[1], []).append(literal)
        self.candidates = {
            tail: sorted(t for prefix in tails if tail.startswith(prefix) for t in tails[prefix])
            for tail in tails
        }
        self.tail_pattern = (
            f" (?=({_longest_match(_prefix_tree(tails), ROOT_GROUP)}))" if tails else None
        )

    def prepared(self, text: Column | str) -> Column:
        """The form of the text that literals are looked up in.

        Padding is skipped where no literal can tell the difference.
        """
        return pad_text(text) if self.needs_padding else F.lower(as_column(text))

    def found(self, prepared: Column) -> Column:
        """Array of the literals that occur in a prepared text; NULL text gives none."""
        parts = []
        if self.spaced:
            seen = F.array_distinct(
                F.regexp_extract_all(prepared, F.lit(self.tail_pattern), F.lit(1))
            )
            lookup = literal_map(self.candidates)
            likely = F.array_distinct(F.flatten(F.transform(seen, lambda t: F.try_element_at(lookup, t))))
            parts.append(F.filter(likely, lambda t: F.contains(prepared, t)))
        if 0 < len(self.solid) <= DIRECT_TESTS:
            tests = [F.when(F.contains(prepared, F.lit(t)), F.lit(t)) for t in self.solid]
            parts.append(F.array_compact(F.array(*tests)))
        elif self.solid:
            parts.append(F.filter(_string_array(self.solid), lambda t: F.contains(prepared, t)))
        if not parts:
            return _string_array([])
        found = F.concat(*parts) if len(parts) > 1 else parts[0]
        return F.coalesce(found, _string_array([]))

    def labels_of(self, found: Column) -> Column:
        """Distinct labels of an array of found literals."""
        if not self.labels:
            return _string_array([])
        lookup = literal_map(self.labels)
        return F.array_distinct(F.flatten(F.transform(found, lambda t: F.try_element_at(lookup, t))))

    def tag(self, text: Column | str) -> Column:
        """Labels of one text as a single expression."""
        return self.labels_of(self.found(self.prepared(text)))


def with_labels(df: DataFrame, targets: Mapping[str, tuple[str, TermIndex]]) -> DataFrame:
    """Add one label array per ``{new column: (text column, index)}``.

    Each text is prepared in a projection of its own, so it is lower-cased once
    however often the lookups read it.
    """
    scratch = {name: f"__{name}_text" for name in targets}
    prepared = df.withColumns(
        {scratch[name]: index.prepared(text) for name, (text, index) in targets.items()}
    )
    tagged = prepared.withColumns(
        {
            name: index.labels_of(index.found(F.col(scratch[name])))
            for name, (_, index) in targets.items()
        }
    )
    return tagged.drop(*scratch.values())


__all__ = ["TermIndex", "term_literal", "with_labels"]
