"""Filling of empty required fields from a supplement table."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..functions.dates import days_since, parse_release_date
from ..functions.numbers import safe_double
from ..functions.text import is_empty, strip
from ..schema import KEY, REQUIRED_COLUMNS
from .columns import add_missing, add_required, as_text, column_or, find_column
from .packing import repartition_packed
from .reduce import keep_likely
from .spread import spread_join
from .validity import count_false, needs_lookup

REAL_INSTALLS = "real_installs"
SUPPLEMENT_COLUMNS = (*REQUIRED_COLUMNS, REAL_INSTALLS)
_LOOKUP, _GAPS, _NTH, _OTHERS, _TASK = "__lookup_key", "__gaps", "__nth", "__others", "__task"
#: how the lookup key of a row that needs no lookup starts
_UNASKED = " "
VALID = "__is_valid"


def map_supplement(
    source: DataFrame, as_of: datetime.date | str | Column | None = None
) -> DataFrame:
    """Rename the fields of a listing source to listing columns, all as text.

    The exact install count stands in for the install bracket unless it is 0 or
    missing, and the release date becomes an age in days.
    """

    def field(name: str) -> Column:
        return column_or(text, name, F.lit(None).cast("string"))

    text = as_text(source)
    real = field("realInstalls")
    usable_real = F.when(~is_empty(real) & (strip(real) != "0"), real)
    # A score is a number with a point: 4 reads as 4.0, as imputed scores do.
    score = field("score")
    if dict(source.dtypes).get(find_column(source, "score")) in ("double", "float"):
        score = F.when(score.rlike("^-?[0-9]+$"), F.concat(score, F.lit(".0"))).otherwise(score)
    columns = {
        KEY: field(KEY),
        "description": field("description"),
        "summary": field("summary"),
        "genreid": field("genreId"),
        "content_rating": field("contentRating"),
        "score": score,
        "ratings_count": field("ratings"),
        "installs": F.coalesce(usable_real, field("installs")),
        "developerid": field("developerId"),
        "developer": field("developer"),
        "free": field("free"),
        "offers_iap": field("offersIAP"),
        "days_since_released": days_since(parse_release_date(field("released")), as_of).cast("string"),
        REAL_INSTALLS: real,
    }
    return text.select(*[c.alias(name) for name, c in columns.items()])


def first_and_least(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column]
) -> DataFrame:
    """The first row of each group by ``order``, and the least of each value over the group."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    least = {name: F.min(value).over(whole) for name, value in values.items()}
    return df.withColumns({_NTH: F.row_number().over(ordered)} | least).where(F.col(_NTH) == 1).drop(_NTH)


def one_per_key(supplement: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One supplement row per stripped key; blank keys are dropped.

    The first row by ``order_by``, then by its number of empty fields, then by all fields
    is kept; a field that is empty there takes the least value that other rows have. Rows are
    first told apart by key and the task that reads them, so that a hot key meets in pieces of
    one input partition at most, and then by key alone. Nothing is sorted before it is shuffled,
    texts are packed, and what follows from the other columns isn't shuffled.
    """
    supplement = add_missing(supplement, SUPPLEMENT_COLUMNS, None)
    order = [*(order_by or []), _GAPS, *SUPPLEMENT_COLUMNS]
    keyed = supplement.where(~is_empty(KEY)).select(
        strip(KEY).alias(_LOOKUP),
        F.spark_partition_id().alias(_TASK),
        count_false(~is_empty(c) for c in SUPPLEMENT_COLUMNS).alias(_GAPS),
        *dict.fromkeys([*(order_by or []), *SUPPLEMENT_COLUMNS]),
    )
    others = {c: f"{_OTHERS}_{c}" for c in SUPPLEMENT_COLUMNS}
    shown = {c: F.when(~is_empty(c), F.col(c)) for c in SUPPLEMENT_COLUMNS}
    unstripped = {KEY: F.nullif(F.col(KEY), F.col(_LOOKUP))}
    stripped = {KEY: F.coalesce(F.col(KEY), F.col(_LOOKUP))}
    moved = repartition_packed(keyed, [_LOOKUP, _TASK], unstripped).withColumns(stripped)
    pieces = first_and_least(moved, [_LOOKUP, _TASK], order, {others[c]: shown[c] for c in shown}).drop(_TASK)
    # a least value that is the chosen row's own is NULL on the way
    less = {o: F.when(~F.col(o).eqNullSafe(shown[c]), F.col(o)) for c, o in others.items()}
    moved = repartition_packed(pieces, [_LOOKUP], unstripped | less).withColumns(stripped)
    known = {o: F.coalesce(F.col(o), shown[c]) for c, o in others.items()}
    chosen = first_and_least(moved, [_LOOKUP], order, known)

    def value(name: str) -> Column:
        return F.when(~is_empty(name), F.col(name)).otherwise(F.col(others[name])).alias(f"__{name}")

    return chosen.select(_LOOKUP, *[value(c) for c in SUPPLEMENT_COLUMNS])


def hydrate(
    listings: DataFrame,
    supplement: DataFrame | None,
    *,
    order_by: list[str] | None = None,
    one_pass: bool | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Fill empty required fields from the supplement row with the same stripped key.

    Only rows with a key and an empty required field take part; their other fields and
    all other rows stay as they are, and the number of rows never changes. Absent
    required columns are added first.

    By default rows that need nothing bypass the join, so only the others are
    shuffled, and supplement rows that none of them asks for are dropped by a bitmap of the
    asked keys before they are; the price is reading the listings three times.
    ``one_pass=True`` reads them once: right for a supplement below the broadcast threshold, and always used for
    streams. The supplement has one row per key, so that adaptive execution splits hot
    keys by itself; with ``hot_rows``, keys above so many rows are split up beforehand.
    """
    return hydrate_and_mark(
        listings, supplement, order_by=order_by, one_pass=one_pass, hot_rows=hot_rows
    ).drop(VALID)


def hydrate_and_mark(
    listings: DataFrame,
    supplement: DataFrame | None,
    *,
    order_by: list[str] | None = None,
    one_pass: bool | None = None,
    hot_rows: int | None = None,
    tested: tuple[str, ...] = REQUIRED_COLUMNS,
    reduced: bool = False,
    observed: Observation | None = None,
) -> DataFrame:
    """``hydrate`` plus a column telling whether the row is valid once installs are resolved.

    The mark is made from the inputs of the filling rather than from its results, which
    keeps the filters on it small. ``tested`` leaves out columns known to be filled;
    ``reduced`` says that the supplement comes from ``one_per_key``. ``observed`` gets the
    counts of ``hydration_counts`` while the rows pass.
    """

    def fill(joined: DataFrame) -> DataFrame:
        if observed is not None:
            asked = F.col(_LOOKUP).isNotNull() & ~F.startswith(F.col(_LOOKUP), F.lit(_UNASKED))
            joined = joined.observe(
                observed,
                F.count_if(asked).alias("targets"),
                F.count_if(asked & F.col(f"__{KEY}").isNotNull()).alias("fetched"),
            )
        return _fill(joined, names, tested)

    listings = add_required(listings)
    if supplement is None:
        return listings.withColumn(VALID, _valid(listings, tested, {}))
    listings = add_missing(listings, [REAL_INSTALLS], None)
    names = listings.columns
    needs = needs_lookup(tested)
    if one_pass or (one_pass is None and listings.isStreaming):
        rows = supplement if reduced else one_per_key(supplement, order_by)
        asked = F.when(needs, strip(KEY))
        if hot_rows is None or listings.isStreaming:
            # NULL keys would all go to one task; no stripped key starts with a space
            asked = F.coalesce(asked, F.concat(F.lit(_UNASKED), F.xxhash64(*[F.col(f"`{c}`") for c in names])))
        return fill(spread_join(listings.withColumn(_LOOKUP, asked), rows, _LOOKUP, "left", hot_rows))
    keyed = listings.where(needs).withColumn(_LOOKUP, strip(KEY))
    if reduced:
        rows = supplement
    else:
        rows = one_per_key(keep_likely(supplement, strip(KEY), keyed.select(_LOOKUP)), order_by)
    filled = fill(spread_join(keyed, rows, _LOOKUP, "left", hot_rows))
    # A row that needs no lookup is complete, unless it has no key.
    complete = listings.where(~needs).withColumn(VALID, ~is_empty(KEY))
    return complete.unionByName(filled)


def _valid(df: DataFrame, tested: tuple[str, ...], found: dict[str, Column]) -> Column:
    """No tested field is empty, counting what was found and the exact install count."""

    def present(name: str) -> Column:
        ok = ~is_empty(name)
        if name in found:
            ok |= ~is_empty(found[name])
        if name == "installs" and REAL_INSTALLS in df.columns:
            ok |= F.coalesce(safe_double(REAL_INSTALLS) > 0, F.lit(False))
            if REAL_INSTALLS in found:
                from_found = is_empty(REAL_INSTALLS) & (safe_double(found[REAL_INSTALLS]) > 0)
                ok |= F.coalesce(from_found, F.lit(False))
        return ok

    return count_false(present(c) for c in tested) == 0


def _fill(joined: DataFrame, names: list[str], tested: tuple[str, ...]) -> DataFrame:
    found = {c: F.col(f"__{c}") for c in SUPPLEMENT_COLUMNS}

    def filled(name: str) -> Column:
        use = is_empty(name) & ~is_empty(found[name])
        return F.when(use, found[name]).otherwise(F.col(name)).alias(name)

    return joined.select(
        *[filled(c) if c in found and c != KEY else F.col(c) for c in names],
        _valid(joined, tested, found).alias(VALID),
    )


def hydration_counts(listings: DataFrame, supplement: DataFrame) -> DataFrame:
    """One row: ``targets`` needing a lookup and ``fetched`` ones with a supplement row.

    Keys are counted before the join, so a hot key crosses the network as one row.
    """
    keys = add_required(listings).where(needs_lookup()).groupBy(strip(KEY).alias(_LOOKUP)).count()
    known = (
        supplement.where(~is_empty(KEY))
        .select(strip(KEY).alias(_LOOKUP))
        .distinct()
        .withColumn("known", F.lit(True))
    )
    return keys.join(known, _LOOKUP, "left").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("targets"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("count"))), F.lit(0)).alias("fetched"),
    )
