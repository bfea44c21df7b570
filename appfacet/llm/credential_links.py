"""Secret scans: certain patterns, and weak candidates that complete each other.

A text's certain spans (assigned values, access ids, long hexadecimal runs) are always
reported. Weak candidates are identifiers in capitals and digits, opaque tokens and
endpoints. Parts of one document within `reach` code points of each other share a scope:
an identifier completes a secret, and a secret an endpoint. A weak candidate is reported
only when such a complement lies in its scope. The parts are interval-joined on stretches
of `reach` code points; the complements of a stretch are reduced to their first and last
position beforehand, so that the join makes a few rows a candidate however many meet.

Defined results: a null or empty text has no spans; repeated rows each get a row; spans
are counted in code points of the whole text, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import cut, map_batches

# fixed values: the certain patterns and least lengths
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE = 12
# weak candidates
ENDPOINT = re.compile(r"""\b[a-z][a-z0-9+]{1,15}://[^\s"'<>]{4,}""")
IDENTIFIER = re.compile(r"\b(?=[A-Z0-9]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{12,40}\b")
OPAQUE = re.compile(r"(?<![\w+/-])(?=[\w+/-]*[0-9])(?=[\w+/-]*[a-z])(?=[\w+/-]*[A-Z])[A-Za-z0-9+/_-]{20,}={0,2}(?![\w+/-])", re.ASCII)

KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
# the role of each kind; a hexadecimal run and an assigned value are secrets
ROLES = ("secret", "identifier", "secret", "identifier", "secret", "endpoint")
_COLUMNS = {
    "doc_id": "long", "n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string",
    "kind": "array<int>", "begin": "array<long>", "end": "array<long>",
}


def certain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the certain patterns, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str, certain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of weak candidates that overlap nothing stronger."""
    found = [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)] if "://" in text else []
    found += [(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text)]
    found += [(m.start(), 4, m.end()) for m in OPAQUE.finditer(text)]
    free, reached, strong = [], 0, 0
    for start, kind, end in sorted(found):
        while strong < len(certain) and certain[strong][0] < end:
            reached = max(reached, certain[strong][2])
            strong += 1
        if start >= reached:
            free.append((start, kind, end))
            reached = end
    return free


def _scan(batches):
    for b in batches:
        out = {name: [] for name in _COLUMNS} | {"doc_id": b["doc_id"]}
        for text in b["text"]:
            certain = certain_spans(text or "")
            spans = certain + weak_spans(text or "", certain)
            kinds = [kind for _, kind, _ in certain]
            for k, name in enumerate(("n_assign", "n_access", "n_hex")):
                out[name].append(kinds.count(k))
            listed = ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in certain)
            out["base_sha256"].append(hashlib.sha256(listed.encode()).hexdigest())
            out["kind"].append([kind for _, kind, _ in spans])
            out["begin"].append([start for start, _, _ in spans])
            out["end"].append([end for _, _, end in spans])
        yield out


def _role(kind):
    return F.element_at(F.array(*map(F.lit, ROLES)), kind + 1)


def linked_weak(parts: DataFrame, reach: int) -> DataFrame:
    """Rows of `parts` (row, kind, begin, end) that are weak and have a complement in scope."""
    stretch = F.floor(F.col("begin") / reach)
    kept = parts.withColumn("role", _role(F.col("kind")))
    there = kept.groupBy("row", stretch.alias("at"), "role").agg(F.min("begin").alias("first"), F.max("begin").alias("last"))
    weak = kept.filter(F.col("kind") >= 3).withColumn("at", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
    other = there.select("row", "at", F.col("role").alias("with_role"), "first", "last")
    complete = (F.col("role") != F.col("with_role")) & ((F.col("role") == "secret") | (F.col("with_role") == "secret"))
    near = (F.col("last") >= F.col("begin") - reach) & (F.col("first") <= F.col("begin") + reach)
    return weak.join(other, ["row", "at"]).filter(complete & near).select("row", "kind", "begin", "end").distinct()


def scan_credentials(docs: DataFrame, reach: int = 300) -> DataFrame:
    """Per row of `docs`: doc_id, counts of certain kinds, digest of the certain spans, and
    `spans`: all reported spans as kind:start:end by start, then kind, comma-joined."""
    scanned = cut(map_batches(docs.select("doc_id", "text"), _scan, _COLUMNS).withColumn("row", F.monotonically_increasing_id()))
    parts = scanned.filter(F.size("kind") > 0).select("row", F.explode(F.arrays_zip("kind", "begin", "end")).alias("at")).select("row", "at.*")
    weak = linked_weak(parts, reach).groupBy("row").agg(F.collect_list(F.struct("begin", "kind", "end")).alias("weak"))
    all_spans = F.arrays_zip("kind", "begin", "end")
    certain = F.transform(F.filter(all_spans, lambda x: x.kind < 3), lambda x: F.struct(x.begin.alias("begin"), x.kind.alias("kind"), x.end.alias("end")))
    names = F.array(*map(F.lit, KINDS))
    listed = F.transform(
        F.array_sort(F.concat(certain, F.coalesce("weak", F.filter(certain, lambda x: F.lit(False))))),
        lambda x: F.concat_ws(":", F.element_at(names, x.kind + 1), x.begin.cast("string"), x.end.cast("string")),
    )
    return scanned.join(weak, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(listed, ",").alias("spans")
    )
