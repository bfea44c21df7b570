import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame of documents from texts or (id, text[, lang, source]) tuples, over several tasks."""

    def make(rows, extra=(), parts=3):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, *rest = row if isinstance(row, tuple) else (i, row)
            lang, source = [*rest, "en", "s1"][:2] if len(rest) < 2 else rest
            full.append((doc_id, text, lang, source, None if text is None else len(text), *("x" for _ in extra)))
        schema = DOCS + "".join(f", `{c}` string" for c in extra)
        return spark.createDataFrame(full, schema).repartition(parts)

    return make


@pytest.fixture
def prose():
    """Seeded invented sentences."""

    def make(seed, words=60, vocabulary=400, per_line=12):
        rng = random.Random(seed)
        out = [f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(words)]
        return "\n".join(" ".join(out[i : i + per_line]) for i in range(0, words, per_line))

    return make
