"""Category labels from rules that stay a table, however many rules there are.

The rules of ``sources.rules`` become part of the plan, which suits a vocabulary of hundreds
of terms. Here they are joined. A genre meets its categories by an equi-join, and they come back
as one array per row. Terms are found by an inverted join:

1. Each text is cut at its spaces, and the distinct tokens of all texts are counted. That
   vocabulary is far smaller than the texts.
2. A term is cut likewise. Its inner pieces are whole tokens of a text that holds it, its first
   piece ends one and its last piece starts one; a term without a space lies within one.
   Pieces meet the vocabulary by equality, or by their pieces of three characters.
3. Each term keeps the piece that fewest texts have, and the tokens that piece matches.
4. The tokens of the texts are joined with those, which gives each text the few terms it may
   hold, and ``contains`` confirms them on the whole text.

No rule is collected or broadcast by force. Tokens that no term asks for are dropped by a bitmap
of fixed size before they are shuffled, and ``hot_rows`` splits frequent tokens (``spread``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.flags import as_flag
from ..functions.text import as_column, is_empty, pad_text, strip
from .categories import CATEGORIES, genre_code
from .columns import column_or, find_column
from .reduce import keep_likely
from .spread import spread_join

#: characters of a piece that vocabulary and terms meet by
GRAM = 3
_CODE, _TEXT, _ID, _TOKEN, _TERMS = "__code", "__text", "__text_id", "__token", "__terms"


def _or_none(labels: Column | str) -> Column:
    return F.coalesce(as_column(labels), F.array().cast("array<string>"))


def genre_table_categories(
    df: DataFrame,
    mapping: DataFrame,
    genre: str = "genreid",
    into: str = CATEGORIES,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add the sorted categories of each row's genre, by a table (genre, category).

    Rows without a genre, or with one that the table doesn't have, get an empty array; a
    mapping row without genre or category counts for nothing, and a repeated one once.
    """
    known = mapping.select(F.col("genre").cast("string").alias(_CODE), F.col("category").cast("string").alias("category"))
    listed = known.dropna().groupBy(_CODE).agg(F.array_sort(F.collect_set("category")).alias("__categories"))
    joined = spread_join(df.withColumn(_CODE, genre_code(genre)), listed, _CODE, "left", hot_rows)
    return joined.withColumn(into, _or_none("__categories")).drop(_CODE, "__categories")


def _literals(rules: DataFrame) -> DataFrame:
    """(literal, categories): what to look for in a padded text; wrong rules fail the job."""
    term = strip("term")
    literal = (
        F.when(is_empty("term"), F.raise_error(F.lit("an empty term would match every text")))
        .when(F.col("mode") == "word", F.concat(F.lit(" "), term, F.lit(" ")))
        .when(F.col("mode") == "substring", term)
        .otherwise(F.raise_error(F.concat(F.lit("unknown term mode "), F.coalesce("mode", F.lit("NULL")))))
    )
    listed = rules.where(F.col("category").isNotNull()).select(literal.alias("literal"), "category")
    return listed.groupBy("literal").agg(F.collect_set("category").alias("categories"))


def _pieces(literals: DataFrame) -> DataFrame:
    """(literal, kind, piece): what a text's tokens show of a literal; whole tokens if there are any."""
    tokens = F.split("literal", " ")
    last = F.size("tokens") - 1
    kinds = F.transform(
        "tokens",
        lambda t, i: F.struct(
            F.when(last == 0, "inside").when(i == 0, "suffix").when(i == last, "prefix").otherwise("whole").alias("kind"),
            t.alias("piece"),
        ),
    )
    seen = literals.select("literal", tokens.alias("tokens")).select("literal", F.filter(kinds, lambda p: p.piece != "").alias("pieces"))
    whole = F.filter("pieces", lambda p: p.kind == "whole")
    return seen.select("literal", F.inline(F.when(F.size(whole) > 0, whole).otherwise(F.col("pieces"))))


def _offered(vocabulary: DataFrame, asked: DataFrame) -> DataFrame:
    """The vocabulary once per distinct piece of up to GRAM characters that may be in ``asked``.

    Pieces are cut in generated code and pass a bitmap where they are cut, so that most of
    them are never a row that moves.
    """
    length, size, place = F.length(_TOKEN), F.col("__size"), F.col("__place")
    sizes = vocabulary.withColumn("__size", F.explode(F.sequence(F.lit(1), F.least(F.lit(GRAM), length))))
    placed = sizes.withColumn("__place", F.explode(F.sequence(F.lit(1), length - size + 1)))
    cut = placed.withColumn("gram", F.substring(_TOKEN, place, size))
    likely = keep_likely(cut, F.col("gram"), asked)
    return likely.where(F.instr(_TOKEN, F.col("gram")) == place).drop("__size", "__place")


def _matches(pieces: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(literal, kind, piece, token, texts): the tokens of the vocabulary that show a piece."""
    whole = pieces.where("kind = 'whole'").join(vocabulary, F.col("piece") == F.col(_TOKEN))
    gram = F.when(F.col("kind") == "suffix", F.right("piece", F.lit(GRAM))).otherwise(F.left("piece", F.lit(GRAM)))
    asked = pieces.where("kind <> 'whole'").withColumn("asked_gram", gram)
    offered = _offered(vocabulary, asked.select("asked_gram"))
    shown = (
        F.when(F.col("kind") == "prefix", F.startswith(_TOKEN, F.col("piece")))
        .when(F.col("kind") == "suffix", F.endswith(F.col(_TOKEN), F.col("piece")))
        .otherwise(F.contains(F.col(_TOKEN), F.col("piece")))
    )
    part = asked.join(offered, F.col("asked_gram") == F.col("gram")).where(shown).drop("asked_gram", "gram")
    return whole.unionByName(part)


def _anchors(literals: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, terms): the tokens that show the rarest piece of literals, and those literals."""
    matches = _matches(_pieces(literals), vocabulary)
    sizes = matches.groupBy("literal", "kind", "piece").agg(F.sum("texts").alias("texts"))
    rarest = sizes.groupBy("literal").agg(F.min(F.struct("texts", "kind", "piece")).alias("chosen"))
    rarest = rarest.select("literal", "chosen.kind", "chosen.piece")
    chosen = matches.join(rarest, ["literal", "kind", "piece"], "left_semi").select(_TOKEN, "literal")
    # one row per token, so that a frequent token of many literals doesn't multiply its texts
    return chosen.join(literals, "literal").groupBy(_TOKEN).agg(F.collect_list(F.struct("literal", "categories")).alias(_TERMS))


def tag_with_rule_table(
    df: DataFrame, text: str, rules: DataFrame, into: str = "labels", hot_rows: int | None = None
) -> DataFrame:
    """Add the sorted categories of the terms that occur in a text column.

    ``rules`` has the columns category, mode (word or substring) and term; texts are compared
    in lower case, stripped and padded by a space, as with ``TermIndex``. A NULL text has no
    labels. Texts are known by a hash: with one hash for two texts either one is tested for
    the terms of both, so the result stays exact.
    """
    if df.isStreaming:
        raise ValueError("rules that stay a table need a finite table: use CategoryRules on streams")
    literals = _literals(rules)
    rows = df.withColumn(_TEXT, pad_text(as_column(text))).withColumn(_ID, F.xxhash64(_TEXT))
    tokens = rows.where(F.col(_TEXT).isNotNull()).select(
        _ID, F.explode(F.array_distinct(F.split(_TEXT, " "))).alias(_TOKEN)
    )
    vocabulary = tokens.where(F.col(_TOKEN) != "").groupBy(_TOKEN).agg(F.count(F.lit(1)).alias("texts"))
    # asked for by every use, so that all of them read one count
    vocabulary = vocabulary.where("texts > 0")
    anchors = _anchors(literals, vocabulary)
    asked = keep_likely(tokens, F.col(_TOKEN), anchors.select(_TOKEN))
    # one row per asked token: a hash of them spares the far larger tokens of the texts a sort
    met = spread_join(asked, anchors.hint("shuffle_hash"), _TOKEN, "inner", hot_rows)
    likely = met.groupBy(_ID).agg(F.flatten(F.collect_set(_TERMS)).alias(_TERMS))
    joined = spread_join(rows, likely, _ID, "left", hot_rows)
    found = F.filter(_TERMS, lambda t: F.contains(F.col(_TEXT), t.literal))
    labels = F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda t: t.categories))))
    return joined.withColumn(into, _or_none(labels)).drop(_TEXT, _ID, _TERMS)


def with_table_categories(df: DataFrame, rules: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Add ``categories``: the sorted union of genre, summary and description by a rule table.

    ``rules`` has the columns category, phase, mode and term. Absent columns count as empty.
    """
    none = F.lit(None).cast("string")
    exact = "genreId" if "genreId" in df.columns else "genreid"
    mapping = rules.where("phase = 'genre'").select(F.col("term").alias("genre"), "category")
    genres = df.withColumn("__genre", column_or(df, exact, none))
    tagged = genre_table_categories(genres, mapping, "__genre", "__genre_labels", hot_rows).drop("__genre")
    parts = ["__genre_labels"]
    for phase in ("summary", "description"):
        column = find_column(df, phase)
        if column:
            terms = rules.where(F.col("phase") == phase)
            tagged = tag_with_rule_table(tagged, column, terms, f"__{phase}_labels", hot_rows)
            parts.append(f"__{phase}_labels")
    union = F.array_sort(F.array_distinct(F.concat(*parts)))
    return tagged.withColumn(CATEGORIES, union).drop(*parts)


def table_category_flags(categories: Iterable[str]) -> dict[str, Column]:
    """One flag per listed category, over the column ``categories``."""
    return {c: as_flag(F.array_contains(CATEGORIES, c)) for c in categories}
