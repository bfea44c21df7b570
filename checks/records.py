"""Listing-shaped tables derived from the given tables, in Spark and in DuckDB.

The column expressions are plain SQL that both engines read alike; the few that differ
are written as ``{name}`` and filled per engine. Every order gives one listing, with
the whole text of the document of the same number as its description where there is
one; every line item gives one supplement row. Vocabulary terms are worked into the
texts, because the prose of the given documents holds none of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from appfacet.sources.tables import with_partitions

from .vocabulary import terms

AS_OF = "2003-01-01"

RATINGS = (
    "Everyone", "Teen", "Mature 17+", "Everyone 10+", "Rated for 3+", "PEGI 3", "Rated for 7+",
    "PEGI 7", "Rated for 12+", "PEGI 12", "Rated for 16+", "PEGI 16", "Rated for 18+", "PEGI 18",
    "Adults only 18+", " MATURE 17+ ", "teen", "Unrated",
)


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def spark_pick(values, index: str) -> str:
    return f"element_at(array({quoted(values)}), CAST({index} AS INT) + 1)"


def duck_pick(values, index: str) -> str:
    return f"list_extract([{quoted(values)}], CAST({index} AS INT) + 1)"


SPARK = {
    "pick": spark_pick,
    "grouped": "format_number(n, 0)",
    "days": f"date_diff(DATE '{AS_OF}', CAST(o_orderdate AS DATE))",
    "short_date": "date_format({d}, 'MMM d, yyyy')",
    "long_date": "date_format({d}, 'MMMM d, yyyy')",
    "iso_date": "date_format({d}, 'yyyy-MM-dd')",
}
DUCK = {
    "pick": duck_pick,
    "grouped": "format('{{:,}}', n)",
    "days": f"date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}')",
    "short_date": "strftime({d}, '%b %-d, %Y')",
    "long_date": "strftime({d}, '%B %-d, %Y')",
    "iso_date": "strftime({d}, '%Y-%m-%d')",
}


def base_columns(e: dict) -> dict[str, str]:
    """First projection over orders left-joined to documents."""
    pick = e["pick"]
    phrases, words, genres = terms("description"), terms("summary"), list(dict.fromkeys(terms("genre")))
    return {
        "k": "o_orderkey",
        "n": "o_orderkey * 7919 % 20000000",
        "owner": "CAST(o_custkey AS STRING)",
        "price": "CAST(floor(o_totalprice) AS BIGINT)",
        "age": e["days"],
        "body": "coalesce(text, 'Order app ' || o_orderpriority || ' status ' || o_orderstatus)",
        "phrase": pick(phrases, f"CAST(floor(o_orderkey / 6) AS BIGINT) % {len(phrases)}"),
        "word": pick(words, f"CAST(floor(o_orderkey / 7) AS BIGINT) % {len(words)}"),
        "genre": pick(genres, f"o_orderkey % {len(genres)}"),
        "rating": pick(RATINGS, f"o_orderkey % {len(RATINGS)}"),
        "short_date": e["short_date"].format(d="o_orderdate"),
        "long_date": e["long_date"].format(d="o_orderdate"),
        "iso_date": e["iso_date"].format(d="o_orderdate"),
    }


def record_columns(e: dict) -> dict[str, str]:
    """Second projection: the raw listing columns, with gaps and junk worked in."""
    grouped = e["grouped"].replace("{{", "{").replace("}}", "}")
    return {
        "bundle_id": """CASE WHEN k % 97 = 13 THEN '  ' WHEN k % 89 = 7 THEN NULL
            WHEN k % 31 = 3 THEN ' app.' || CAST(k AS STRING) || ' '
            ELSE 'app.' || CAST(k AS STRING) END""",
        "description": """CASE WHEN k % 61 = 5 THEN '' WHEN k % 67 = 1 THEN NULL
            WHEN k % 71 = 2 THEN ' ' || chr(160) || chr(9)
            WHEN k % 6 = 0 THEN body
            WHEN k % 6 = 1 THEN body || ' ' || phrase
            WHEN k % 6 = 2 THEN phrase || ' ' || body
            WHEN k % 6 = 3 THEN body || upper(phrase) || 'x'
            WHEN k % 6 = 4 THEN body || ' ' || replace(phrase, ' ', chr(10))
            ELSE phrase || chr(10) || body END""",
        "summary": """CASE WHEN k % 59 = 4 THEN '   ' WHEN k % 73 = 6 THEN NULL
            WHEN k % 7 = 0 THEN 'An app for all'
            WHEN k % 7 = 1 THEN word
            WHEN k % 7 = 2 THEN word || ' for you'
            WHEN k % 7 = 3 THEN 'The best ' || word
            WHEN k % 7 = 4 THEN 'Try ' || word || ', now'
            WHEN k % 7 = 5 THEN 'Pre' || word || 'ed tools'
            ELSE ' Your ' || upper(word) || ' helper  ' || chr(9) END""",
        "genreid": """CASE WHEN k % 57 = 50 THEN 'UNKNOWN_GENRE' WHEN k % 57 = 51 THEN ''
            WHEN k % 57 = 52 THEN NULL WHEN k % 3 = 1 THEN ' ' || lower(genre) || ' '
            ELSE genre END""",
        "content_rating": """CASE WHEN k % 47 = 1 THEN '' WHEN k % 47 = 2 THEN NULL
            ELSE rating END""",
        "score": """CASE WHEN k % 83 = 1 THEN 'nan' WHEN k % 83 = 2 THEN 'abc'
            WHEN k % 83 = 3 THEN '1d' WHEN k % 83 = 4 THEN '' WHEN k % 83 = 5 THEN NULL
            WHEN k % 83 = 6 THEN ' 4.5 ' WHEN k % 83 = 7 THEN '1e999' WHEN k % 83 = 8 THEN '-0.5'
            ELSE CAST(CAST(k * 37 % 51 AS DOUBLE) / 10 AS STRING) END""",
        "ratings_count": """CASE WHEN k % 41 = 2 THEN '' WHEN k % 43 = 3 THEN NULL
            ELSE CAST(price AS STRING) END""",
        "installs": f"""CASE WHEN k % 37 = 1 THEN 'Varies with device'
            WHEN k % 37 = 2 THEN CAST(n AS STRING) WHEN k % 37 = 3 THEN '1 000 000+'
            WHEN k % 37 = 4 THEN '-5' WHEN k % 37 = 5 THEN '' WHEN k % 37 = 6 THEN NULL
            WHEN k % 223 = 9 THEN '1e22' WHEN k % 37 = 7 THEN '0' WHEN k % 37 = 8 THEN '1_000'
            ELSE {grouped} || '+' END""",
        "developerid": "CASE WHEN k % 101 = 1 THEN '' ELSE 'dev' || owner END",
        "developer": "CASE WHEN k % 103 = 1 THEN chr(9) ELSE 'Customer ' || owner END",
        "free": """CASE WHEN k % 79 = 3 THEN '' WHEN k % 11 = 0 THEN 'True'
            WHEN k % 11 = 1 THEN 'false' WHEN k % 11 = 2 THEN ' YES ' WHEN k % 11 = 3 THEN 'no'
            WHEN k % 11 = 4 THEN '1' WHEN k % 11 = 5 THEN '0' WHEN k % 11 = 6 THEN 'maybe'
            ELSE 'true' END""",
        "offers_iap": """CASE WHEN k % 109 = 3 THEN NULL WHEN k % 13 = 0 THEN 'FALSE'
            WHEN k % 13 = 1 THEN ' 0' WHEN k % 13 = 2 THEN 'yes' WHEN k % 13 = 3 THEN 'True '
            WHEN k % 13 = 4 THEN '1.0' ELSE 'no' END""",
        "days_since_released": """CASE WHEN k % 53 = 5 THEN '' WHEN k % 53 = 6 THEN 'soon'
            ELSE CAST(age % 1200 AS STRING) END""",
        "real_installs": """CASE WHEN k % 211 = 1 THEN '1e19' WHEN k % 211 = 2 THEN '1e22' WHEN k % 9 = 0 THEN CAST(n AS STRING) WHEN k % 9 = 1 THEN '0'
            WHEN k % 9 = 2 THEN 'junk' WHEN k % 9 = 3 THEN '123456.7' WHEN k % 9 = 4 THEN '-3'
            ELSE NULL END""",
        "min_installs": "CASE WHEN k % 4 = 0 THEN CAST(n AS STRING) ELSE NULL END",
        "months": """CASE WHEN k % 10 < 3 THEN CAST(k % 40 AS STRING) WHEN k % 10 = 3 THEN '3.5'
            WHEN k % 10 = 4 THEN 'old' ELSE NULL END""",
        "released": """CASE WHEN k % 7 = 0 THEN short_date WHEN k % 7 = 1 THEN iso_date
            WHEN k % 7 = 2 THEN long_date WHEN k % 7 = 3 THEN upper(short_date)
            WHEN k % 7 = 4 THEN ' ' || short_date WHEN k % 7 = 5 THEN 'Feb 30, 2020'
            ELSE replace(long_date, ' ', '   ') END""",
    }


def source_columns(e: dict) -> dict[str, str]:
    """Raw rows of a listing source, from line items; keys repeat and some are padded."""
    return {
        "bundle_id": """CASE WHEN l_orderkey % 103 = 5 THEN ' '
            WHEN l_orderkey % 17 = 2 THEN ' app.' || CAST(l_orderkey * 2 AS STRING) || '  '
            ELSE 'app.' || CAST(l_orderkey * 2 AS STRING) END""",
        "description": """CASE WHEN l_partkey % 5 = 0 THEN ''
            WHEN l_linenumber % 2 = 0 THEN 'Item ' || l_returnflag || ' for online shopping'
            ELSE 'Item ' || l_linestatus || ' with a mock test' END""",
        "summary": "CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'shopping and sudoku' END",
        "genreId": "CASE WHEN l_linenumber % 2 = 0 THEN 'SHOPPING' ELSE 'GAME_WORD' END",
        "contentRating": "CASE WHEN l_linenumber % 3 = 0 THEN 'Teen' ELSE 'PEGI 7' END",
        "score": "l_quantity / 10",
        "ratings": "CAST(floor(l_extendedprice) AS BIGINT)",
        "realInstalls": """CASE WHEN l_linenumber % 3 = 0 THEN CAST(0 AS BIGINT)
            WHEN l_linenumber % 3 = 1 THEN CAST(floor(l_extendedprice * 10) AS BIGINT)
            ELSE NULL END""",
        "installs": "CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE '50,000+' END",
        "developerId": "'sup' || CAST(l_suppkey AS STRING)",
        "developer": "'Supplier ' || CAST(l_suppkey AS STRING)",
        "free": "l_tax > CAST(0.04 AS DOUBLE)",
        "offersIAP": "l_discount > CAST(0.05 AS DOUBLE)",
        "released": e["short_date"].format(d="l_shipdate"),
    }


RULE_TERMS = (
    "tokens[{0}]",
    "tokens[{1}] || ' ' || tokens[{2}]",
    "substring(tokens[{3}], 2, 4)",
    "tokens[{4}] || ' ' || tokens[{5}] || ' ' || tokens[{6}]",
    "tokens[{7}]",
)
RULE_MODES = ("word", "substring", "substring", "substring", "word")


def rules_sql(split: str, first: int, frequent: dict[str, list[tuple[str, str]]]) -> str:
    """A rule table (category, mode, term) of the benchmark items' own terms and of very frequent ones."""
    own = " UNION ALL ".join(
        f"SELECT 'item' || CAST(item_id % 7 AS STRING) AS category, '{mode}' AS mode, {term.format(*range(first, first + 8))} AS term "
        f"FROM (SELECT item_id, {split}(lower(text), ' ') AS tokens FROM benchmark) WHERE length({term.format(*range(first, first + 8))}) > 2"
        for mode, term in zip(RULE_MODES, RULE_TERMS, strict=True)
    )
    also = " UNION ALL ".join(
        f"SELECT '{name}', '{mode}', '{term}'" for name, found in frequent.items() for term, mode in found
    )
    return f"{own} UNION ALL {also}"


# --- Spark -----------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table over all cores also where its file has fewer input splits; as read otherwise."""
    read, cores = table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    return with_partitions(read, cores if read.rdd.getNumPartitions() < cores else None)


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw column, with ``months`` and ``released`` beside the listing columns."""
    orders, documents = spread_table(spark, sf_dir, "orders"), table(spark, sf_dir, "documents")
    joined = orders.join(documents, F.col("doc_id") == F.col("o_orderkey"), "left")
    return _select(_select(joined, base_columns(SPARK)), record_columns(SPARK))


def app_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_records(spark, sf_dir).drop("months", "released")


def app_records_with_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = all_records(spark, sf_dir).drop("released")
    return renamed.withColumnRenamed("months", "months_since_launch")


def listing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spread_table(spark, sf_dir, "lineitem"), source_columns(SPARK))


def key_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.selectExpr("' app.' || CAST(event_id * 3 AS STRING) AS wanted")


# --- DuckDB ----------------------------------------------------------------
def _duck_select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ",\n".join(f"{sql} AS {name}" for name, sql in columns.items()) + f"\nFROM {source}"


def duck_ctes() -> dict[str, str]:
    source = "orders LEFT JOIN documents ON doc_id = o_orderkey"
    return {
        "base": _duck_select(base_columns(DUCK), source),
        "all_records": _duck_select(record_columns(DUCK), "base"),
        "app_records": "SELECT * EXCLUDE (months, released) FROM all_records",
        "listing_source": _duck_select(source_columns(DUCK), "lineitem"),
        "key_table": "SELECT ' app.' || CAST(event_id * 3 AS STRING) AS wanted FROM events",
    }
