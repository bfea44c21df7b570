"""The same results in DuckDB SQL, written independently of the Spark expressions."""

from __future__ import annotations

from .records import AS_OF, duck_ctes, quoted
from .vocabulary import categories, terms

REQUIRED = (
    "bundle_id", "description", "summary", "genreid", "content_rating", "score", "ratings_count",
    "installs", "developerid", "developer", "free", "offers_iap", "days_since_released",
)
WS = "'" + "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
              0x2029, 0x202F, 0x205F, 0x3000])
) + "'"
TRUE, FALSE = "('true', '1', 'yes')", "('false', '0', 'no')"


# --- expressions -----------------------------------------------------------
def strip(x):
    return f"trim({x}, {WS})"


def empty(x):
    return f"({x} IS NULL OR {strip(x)} = '')"


def token(x):
    return f"lower({strip(x)})"


def num(x):
    value = f"try_cast(trim({x}) AS DOUBLE)"
    shape = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
    return (
        f"(CASE WHEN regexp_matches({x}, '{shape}') AND NOT isinf({value}) THEN {value} END)"
    )


def count_number(x):
    return num(f"regexp_replace({x}, '[,+\\s]', '', 'g')")


def flag(condition):
    return f"(CASE WHEN {condition} THEN 1 ELSE 0 END)"


def aliased(columns: dict[str, str]) -> str:
    return ",\n".join(f"{sql} AS {name}" for name, sql in columns.items())


def binned(x, names, missing, edges, closed="left"):
    """Flags of intervals from high to low edges (left) or low to high (right)."""
    out = {}
    if closed == "left":
        tops = [None, *edges[:-1], edges[-1]]
        for i, name in enumerate(names):
            low = f"{x} >= {edges[i]}" if i < len(edges) else "TRUE"
            high = f"{x} < {tops[i]}" if tops[i] is not None else "TRUE"
            out[name] = flag(f"{x} IS NOT NULL AND {low} AND {high}")
    else:
        lows = [None, *edges]
        for i, name in enumerate(names):
            low = f"{x} > {lows[i]}" if lows[i] is not None else "TRUE"
            high = f"{x} <= {edges[i]}" if i < len(edges) else "TRUE"
            out[name] = flag(f"{x} IS NOT NULL AND {low} AND {high}")
    out[missing] = flag(f"{x} IS NULL")
    return out


SCORE_NAMES = ("score_45plus", "score_40_45", "score_30_40", "score_below30")
INSTALL_NAMES = ("installs_10m_plus", "installs_1m_10m", "installs_100k_1m", "installs_below100k")
AGE_NAMES = ("apps_0_3months", "apps_3_12months", "apps_1_2years", "apps_2plus_years")


def score_flags():
    return binned(num("score"), SCORE_NAMES, "score_missing", (4.5, 4.0, 3.0))


def install_flags(min_installs=True):
    x = count_number("installs")
    x = f"coalesce({x}, {num('min_installs')})" if min_installs else x
    return binned(x, INSTALL_NAMES, "installs_missing", (10000000, 1000000, 100000))


def age_flags(months):
    return binned(f"({months})", AGE_NAMES, "app_age_missing", (3, 12, 24), "right")


def derived_months():
    return f"CAST(trunc({num('days_since_released')} / CAST(30.44 AS DOUBLE)) AS BIGINT)"


def pricing_flags():
    return {
        "is_free_app": flag(f"{token('free')} IN {TRUE}"),
        "is_paid_app": flag(f"{token('free')} IN {FALSE}"),
        "offers_iap_flag": flag(f"{token('offers_iap')} IN {TRUE}"),
        "no_iap_flag": flag(f"{token('offers_iap')} IN {FALSE}"),
    }


RATING_SETS = {
    "rating_everyone": ["everyone"],
    "rating_teen": ["teen"],
    "rating_mature": ["mature 17+"],
    "rating_everyone10plus": ["everyone 10+"],
    **{f"rating_rated{n}plus": [f"rated for {n}+", f"pegi {n}"] for n in (3, 7, 12, 16, 18)},
    "rating_adults18plus": ["adults only 18+"],
}


def rating_flags():
    t = token("content_rating")
    known = quoted(v for vs in RATING_SETS.values() for v in vs)
    return {
        **{name: flag(f"{t} IN ({quoted(vs)})") for name, vs in RATING_SETS.items()},
        "rating_missing": flag(empty("content_rating")),
        "rating_other": flag(f"NOT {empty('content_rating')} AND {t} NOT IN ({known})"),
    }


def padded(x):
    return f"(' ' || {strip(f'lower({x})')} || ' ')"


def any_term(x, literals):
    return "(" + " OR ".join(f"contains({x}, '{t}')" for t in literals) + ")"


def hits(category):
    """Genre, summary and description condition of a category over columns g, s, d."""
    genres, words, phrases = (terms(p, category) for p in ("genre", "summary", "description"))
    literals = [w if " " in w else f" {w} " for w in words]
    return (
        f"coalesce(g IN ({quoted(genres)}), FALSE)" if genres else "FALSE",
        f"coalesce({any_term('s', literals)}, FALSE)",
        f"coalesce({any_term('d', phrases)}, FALSE)",
    )


def phased(source):
    """A relation with the columns g, s and d that hits() reads."""
    return (
        f"(SELECT *, upper({strip('genreid')}) AS g, {padded('summary')} AS s, "
        f"{padded('description')} AS d FROM {source})"
    )


def category_flags():
    return {c: flag(" OR ".join(hits(c))) for c in categories()}


def labels(conditions: dict[str, str]) -> str:
    """Sorted comma-separated names of the conditions that hold."""
    items = [f"CASE WHEN {c} THEN '{n}' END" for n, c in conditions.items()]
    return f"array_to_string(list_sort(list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)), ',')"


# --- relations -------------------------------------------------------------
def valid(required=REQUIRED):
    return " AND ".join(f"NOT {empty(c)}" for c in required)


def parsed_date(x):
    t = f"regexp_replace({x}, '(\\S)\\s+(\\S)', '\\1 \\2', 'g')"
    shapes = [
        (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", "%b %d, %Y"),
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "%Y-%m-%d"),
        (r"^[A-Za-z]+ \d{1,2}, \d{4}$", "%B %d, %Y"),
    ]
    tries = [
        f"CASE WHEN regexp_matches({t}, '{s}') THEN CAST(try_strptime({t}, '{f}') AS DATE) END"
        for s, f in shapes
    ]
    return f"coalesce({', '.join(tries)})"


def age_in_days(x):
    return f"greatest(0, date_diff('day', {x}, DATE '{AS_OF}'))"


def number_text(x):
    return (
        f"(CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS STRING) "
        f"ELSE CAST({x} AS STRING) END)"
    )


def bool_text(x):
    return f"(CASE WHEN {x} THEN 'True' WHEN NOT {x} THEN 'False' END)"


SUPPLEMENT = {
    "bundle_id": "bundle_id",
    "description": "description",
    "summary": "summary",
    "genreid": "genreId",
    "content_rating": "contentRating",
    "score": "CAST(CAST(score AS DOUBLE) AS STRING)",
    "ratings_count": "CAST(ratings AS STRING)",
    "installs": "coalesce(CAST(nullif(realInstalls, 0) AS STRING), installs)",
    "developerid": "developerId",
    "developer": "developer",
    "free": bool_text("free"),
    "offers_iap": bool_text("offersIAP"),
    "days_since_released": (
        f"CASE WHEN {parsed_date('released')} IS NOT NULL "
        f"THEN CAST({age_in_days(parsed_date('released'))} AS STRING) END"
    ),
    "real_installs": "CAST(realInstalls AS STRING)",
}


def hydrated(source):
    needs = "(" + " OR ".join(empty(f"r.{c}") for c in REQUIRED) + f") AND NOT {empty('r.bundle_id')}"
    fill = {
        c: f"CASE WHEN {empty(f'r.{c}')} AND NOT {empty(f's.{c}')} THEN s.{c} ELSE r.{c} END"
        for c in (*REQUIRED, "real_installs")
    }
    replaced = ", ".join(f"{sql} AS {c}" for c, sql in fill.items())
    return (
        f"SELECT r.* REPLACE ({replaced}) FROM {source} r LEFT JOIN supplement_one s "
        f"ON {needs} AND {strip('r.bundle_id')} = s.lookup_key"
    )


def resolved(source):
    real = num("real_installs")
    return (
        f"SELECT * EXCLUDE (real_installs) REPLACE (CASE WHEN {real} > 0 "
        f"THEN CAST(CAST(trunc({real}) AS HUGEINT) AS STRING) ELSE installs END AS installs) "
        f"FROM {source}"
    )


def imputed(source, key="bundle_id"):
    counts = [f"CASE WHEN {count_number(c)} > 0 THEN {count_number(c)} END" for c in
              ("installs", "real_installs", "min_installs")]
    u = (
        f"CAST(('0x' || substr(md5(coalesce({key}, '') || ':0'), 1, 8)) AS BIGINT) "
        "/ CAST(4294967296 AS DOUBLE)"
    )
    score = f"round(CAST(3.0 AS DOUBLE) + {u} * (CAST(4.3 AS DOUBLE) - CAST(3.0 AS DOUBLE)), 1)"
    days = (
        "least(1825, greatest(90, CAST(trunc(CAST(90 AS DOUBLE) + CAST(180 AS DOUBLE) "
        "* log10(CAST(r AS DOUBLE))) AS INTEGER)))"
    )
    replaced = ", ".join(
        f"CASE WHEN {empty(c)} THEN CAST({v} AS STRING) ELSE {c} END AS {c}"
        for c, v in {"score": score, "ratings_count": "r", "days_since_released": days}.items()
    )
    return (
        f"SELECT * EXCLUDE (r) REPLACE ({replaced}) FROM (SELECT *, greatest(1, CAST(trunc("
        f"coalesce({', '.join(counts)}, CAST(100000 AS DOUBLE)) * CAST(0.01 AS DOUBLE)) AS HUGEINT))"
        f" AS r FROM {source})"
    )


def final_flags(months, min_installs=True):
    return (
        category_flags()
        | score_flags()
        | install_flags(min_installs)
        | age_flags(months)
        | pricing_flags()
        | rating_flags()
    )


def enriched(source, months=None, min_installs=True):
    months = months or derived_months()
    kept = ", ".join(REQUIRED)
    return (
        f"SELECT {kept}, {months} AS months_since_launch,\n"
        f"{aliased(final_flags(months, min_installs))}\nFROM {phased(f'{source} WHERE {valid()}')}"
    )


def percent(part, total):
    return f"coalesce(CAST({part} AS DOUBLE) / nullif(CAST({total} AS DOUBLE), 0) * 100, CAST(0 AS DOUBLE))"


def ctes() -> dict[str, str]:
    gaps = " + ".join(f"CAST({empty(c)} AS INTEGER)" for c in SUPPLEMENT)
    order = ", ".join((gaps, *(f"{c} NULLS FIRST" for c in SUPPLEMENT)))
    own = ", ".join(
        f"coalesce(CASE WHEN NOT {empty(c)} THEN {c} END, min({c}) FILTER (NOT {empty(c)}) OVER one) AS {c}"
        for c in SUPPLEMENT
    )
    named = {
        **duck_ctes(),
        "with_months": "SELECT * EXCLUDE (released, months), months AS months_since_launch FROM all_records",
        "supplement": f"SELECT {aliased(SUPPLEMENT)} FROM listing_source",
        "supplement_one": (
            f"SELECT {strip('bundle_id')} AS lookup_key, {own} FROM supplement WHERE NOT {empty('bundle_id')} "
            f"WINDOW one AS (PARTITION BY {strip('bundle_id')}) "
            f"QUALIFY row_number() OVER (PARTITION BY {strip('bundle_id')} ORDER BY {order}) = 1"
        ),
        "hydrated": hydrated("app_records"),
        "resolved": resolved("app_records"),
        "resolved_hydrated": resolved("hydrated"),
        "resolved_months": resolved("with_months"),
        "months_valid": f"SELECT * FROM resolved_months WHERE {valid()}",
        "enriched": enriched("resolved"),
        "ids": (
            "SELECT 'app.' || CAST(o_orderkey AS STRING) AS bundle_id, "
            + ", ".join(f"'' AS {c}" for c in REQUIRED[1:])
            + ", CAST(NULL AS STRING) AS real_installs FROM orders"
        ),
        "ids_resolved": resolved(f"({hydrated('ids')})"),
        "wanted": f"SELECT DISTINCT {strip('wanted')} AS wanted FROM key_table WHERE NOT {empty('wanted')}",
        "key_rows": (
            f"SELECT r.* FROM app_records r WHERE {strip('r.bundle_id')} IN (SELECT wanted FROM wanted) "
            "UNION ALL BY NAME SELECT * EXCLUDE (lookup_key) REPLACE (lookup_key AS bundle_id) "
            "FROM supplement_one WHERE lookup_key IN (SELECT wanted FROM wanted) AND lookup_key "
            f"NOT IN (SELECT {strip('bundle_id')} FROM app_records WHERE bundle_id IS NOT NULL)"
        ),
        "keys_imputed": imputed("key_rows"),
        "keys_hydrated": hydrated("keys_imputed"),
        "keys_resolved": resolved("keys_hydrated"),
        "phrase_docs": (
            "SELECT doc_id, "
            + "text || ' ' || "
            + f"list_extract([{quoted(terms('description'))}], CAST(doc_id % {len(terms('description'))} AS INT) + 1)"
            + " AS text FROM documents"
        ),
    }
    return named


def with_ctes(body: str) -> str:
    """Prefix a query with the derived relations it uses, directly or through others."""
    import re

    named = ctes()
    used: set[str] = set()

    def visit(sql):
        for name in named:
            if name not in used and re.search(rf"\b(?:FROM|JOIN) {name}\b", sql):
                used.add(name)
                visit(named[name])

    visit(body)
    parts = [f"{name} AS (\n{sql}\n)" for name, sql in named.items() if name in used]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
