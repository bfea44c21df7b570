import pytest
from pyspark.sql import functions as F

from appfacet.functions import (
    TermIndex,
    days_since,
    first_positive_count,
    is_empty,
    months_from_days,
    pad_text,
    parse_bool,
    parse_count,
    parse_release_date,
    safe_double,
    strip,
    term_literal,
)


def values(table, cells, expression):
    rows = table([{"i": str(i), "x": c} for i, c in enumerate(cells)], ["i", "x"])
    return [r[1] for r in sorted(rows.select("i", expression).collect(), key=lambda r: int(r[0]))]


def test_empty_and_strip(table):
    cells = [None, "", "   ", "\t", " ", "　\x1c\x85", "0", "False", " a "]
    assert values(table, cells, is_empty("x")) == [True] * 6 + [False] * 3
    assert values(table, ["  a b \n", None], strip("x")) == ["a b", None]
    assert values(table, [" Ab\n", None], pad_text("x")) == [" ab ", None]


def test_numbers(table):
    cells = ["4.5", " 7 ", ".5", "5.", "1e3", "-2", "nan", "inf", "1d", "1_000", "abc", "", None, "1e999"]
    expected = [4.5, 7.0, 0.5, 5.0, 1000.0, -2.0] + [None] * 8
    assert values(table, cells, safe_double("x")) == expected
    counts = ["10,000,000+", "1 000 000+", "100000", "-5", "Varies", None]
    assert values(table, counts, parse_count("x")) == [1e7, 1e6, 1e5, -5.0, None, None]
    assert values(table, ["Varies", "5"], parse_count("x", F.lit("12"))) == [12.0, 5.0]
    assert values(table, ["0", "-1", "8+"], first_positive_count("x", F.lit("3"))) == [3.0, 3.0, 8.0]


def test_release_dates(table):
    cells = [
        "Jan 5, 2020", "JAN 05, 2020", "2020-1-5", "January 5, 2020", "May  5,  2020",
        "Feb 30, 2020", " Jan 5, 2020", "Jan 5, 2020 ", "Jan 5, 20201", "05.01.2020", "", None,
    ]
    days = values(table, cells, days_since(parse_release_date("x"), "2020-06-01"))
    assert days == [148, 148, 148, 148, 27] + [None] * 7
    future = days_since(parse_release_date("x"), "2019-01-01")
    assert values(table, ["Jan 5, 2020"], future) == [0]


@pytest.mark.parametrize("days, months", [(91, 2), (92, 3), (121, 3), (122, 4), (0, 0)])
def test_months(spark, days, months):
    assert spark.range(1).select(months_from_days(F.lit(float(days)))).first()[0] == months


def test_booleans(table):
    cells = ["True", " yes ", "1", "FALSE", "no", "0", "maybe", "1.0", "", None]
    assert values(table, cells, parse_bool("x")) == [True] * 3 + [False] * 3 + [None] * 4


def brute_force(text, labels, padded):
    text = text.lower()
    text = f" {text.strip()} " if padded else text
    return {label for term, ls in labels.items() if term in text for label in ls}


def test_term_index_agrees_with_plain_search(table):
    labels = {
        " invest ": ["a"], "stock market": ["a", "b"], "stock market app": ["c"], "market": ["d"],
        "video chat with friends": ["e"], "chat with friends": ["f"], "a b c": ["g"], "xa b": ["h"],
        "c++ (beta) x": ["i"], "c.d e": ["j"], "nifty 50": ["k"], " 5 ": ["l"], "eé üx": ["m"],
    }
    texts = [
        "invest", "Invest now", "to invest", "invest,", "reinvest", "livestock markets", "stock\nmarket",
        "Stock Market Application", "my video chat with friends!", "xa b c", "a b c", "a  b c",
        "c++ (beta) xy", "cxd e", "c.d e", "nifty 500", "5", "15", "EÉ ÜX", "", "   ", "stock market stock",
        "a b a b c", "invest invest",
    ]
    index = TermIndex(labels)
    found = values(table, [*texts, None], index.tag("x"))
    assert [set(f) for f in found] == [brute_force(t, labels, True) for t in texts] + [set()]
    assert all(len(f) == len(set(f)) for f in found)
    raw = {t: ls for t, ls in labels.items() if t == t.strip()}
    found = values(table, texts, TermIndex(raw).tag("x"))
    assert [set(f) for f in found] == [brute_force(t, raw, False) for t in texts]


def test_many_terms_without_space(table):
    labels = {f"term{i:03d}x": [f"l{i % 7}"] for i in range(120)} | {"two words": ["w"]}
    texts = ["term003x", "xterm119xterm050x two words", "term3x", ""]
    found = values(table, texts, TermIndex(labels).tag("x"))
    assert [set(f) for f in found] == [brute_force(t, labels, False) for t in texts]


def test_term_literals():
    assert term_literal("tap", "word") == " tap "
    assert term_literal(" tap to play ", "substring") == "tap to play"
    with pytest.raises(ValueError):
        term_literal("tap", "prefix")
    with pytest.raises(ValueError):
        TermIndex({"": ["a"]})
