import random
import zlib

import numpy as np
import pytest

from appfacet.llm import word_runs


def brute_runs(words):
    """All runs by comparing the words with themselves, one period after the other."""
    found = []
    for period in range(1, len(words) // 3 + 1):
        i = 0
        while i + period < len(words):
            j = i
            while j + period < len(words) and words[j] == words[j + period]:
                j += 1
            if j + period - i >= max(24, 3 * period):
                smaller = any(q < period and period % q == 0 and s <= i and j + period <= s + n for s, n, q in found)
                if not smaller:
                    found.append((i, j + period - i, period))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(rng, vocabulary, n):
    words = [rng.randrange(vocabulary) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        a, p = rng.randrange(n), rng.randrange(1, max(2, n // 3))
        b = min(n, a + p * rng.randrange(1, 8))
        for i in range(a, b):
            words[i] = words[a + (i - a) % p]
        if rng.random() < 0.4:
            words[rng.randrange(n)] = vocabulary
    return words


def numbers(words):
    return word_runs.number_words([str(w).encode() for w in words])


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 50])
def test_runs_equal_plain_ones(vocabulary):
    rng = random.Random(vocabulary)
    for _ in range(400):
        words = planted(rng, vocabulary, rng.randrange(1, 160))
        assert word_runs.find_runs(numbers(words)) == brute_runs(words)


def test_fibonacci_words_and_powers():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    for text in (b, "a" * 500, "ab" * 200 + "c" + "ab" * 200, ("x" * 30 + "y") * 9, ("abcabcabcabcabcabcabcabcabcabd") * 5):
        assert word_runs.find_runs(numbers(text)) == brute_runs([*text])


def test_grammar_gives_the_text_back():
    rng = random.Random(4)
    words = np.array(planted(rng, 3, 300))
    grammar = word_runs.Grammar(words, [(0, 300)])

    def expand(symbol):
        return [symbol] if symbol < grammar.base else expand(grammar.parts[symbol - grammar.base][0]) + expand(grammar.parts[symbol - grammar.base][1])

    assert expand(grammar.tops[0][0]) == words.tolist()
    for k, (first, size) in enumerate(zip(grammar.first, grammar.sizes, strict=True)):
        assert expand(grammar.base + k) == words[first : first + size].tolist()


def planted_words(doc_id, words):
    """The words after the periodic change that the query makes."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def brute_row(doc_id, text):
    import hashlib

    words = planted_words(doc_id, [w.decode() for w in (text or "").encode().split()])
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    best = (None,) * 4
    if runs:
        top = runs[0]
        for r in runs[1:]:
            if r[1] * top[2] > top[1] * r[2]:
                top = r
        best = (*top, 1000 * top[1] // top[2])
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(left))


def test_query_equals_plain_version(spark, documents, prose, tmp_path):
    from appfacet.llm.queries import op11_word_runs

    rng = random.Random(2)
    rows = [(i, " ".join(prose(i, rng.randrange(1, 300)).split()), "en", "src0") for i in range(150)]
    rows += [(1000 + i, "a  b\tc\n" * 40 + "\x0bend   x", "en", "src0") for i in range(20)]
    rows += [(2000, None, "en", None), (2001, "", None, "s"), (2002, " \n\t", "en", "s"), (2003, "a", "en", "s"), (1000, "a b c", "en", "s")]
    rows += [(3000, " ".join(str(w) for w in planted(rng, 5, 6000)), "en", "s")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    out = op11_word_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr(brute_row(r[0], r[1])) for r in rows)


def test_no_rows_and_clashing_columns(spark, documents):
    from pyspark.sql import functions as F

    empty = documents([]).withColumn("runs", F.lit(1)).withColumn("starts", F.lit("x"))
    assert word_runs.collapse_runs(empty).collect() == []
    one = documents([(None, "a b " * 30, "en", "s")]).withColumn("runs", F.lit(1)).withColumn("n_words", F.lit("x"))
    (row,) = word_runs.collapse_runs(one).collect()
    assert (row.doc_id, row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (None, 60, [(0, 60, 2)], "a b")
