"""The registered queries of the operators and, where SQL can say it, their SQL twins.

Each query applies its operator to a whole table with production parameters and derives
the columns of its contract from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from appfacet.llm import chat_trees, credential_links, fuzzy_lines, histogram_packing, line_quality, ngram_join, norm_topk, token_prefix, toxic_segments, turn_repair, url_templates, weight_tree, word_runs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


PROBE = "\\### Assistant: </turn> ok"


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Conversations as reply trees: each turn answers the one before."""
    probe = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(probe)
    nth = F.row_number().over(chat_trees.Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    rows = rows.withColumn("node", nth)
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(F.col("conv_id").alias("tree"), "node", parent.alias("parent"), "role", F.coalesce("text", F.lit("")).alias("text"), F.lit(1.0).alias("score"))


def op2_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = chat_trees.reply_paths(conversation_messages(table(spark, sf_dir, "conversations")))
    formatted = chat_trees.cut(chat_trees.format_paths(paths))
    turns = chat_trees.parse_conversations(formatted)
    whole = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    listed = turns.groupBy("tree", "leaf").agg(
        F.count("*").alias("n_turns"),
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", whole.alias("t")))), lambda x: x.t), ""), 256).alias("turns_sha256"),
        F.sum(F.coalesce(F.length("loss_text"), F.lit(0))).cast("long").alias("loss_chars"),
        F.sha2(
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", F.coalesce("loss_text", F.lit("")).alias("t")))), lambda x: x.t), ""), 256
        ).alias("loss_sha256"),
    )
    sizes = formatted.select(F.col("tree").alias("f_tree"), F.col("leaf").alias("f_leaf"), F.length("formatted").cast("long").alias("formatted_chars"))
    joined = listed.join(sizes, F.col("tree").eqNullSafe(F.col("f_tree")) & (F.col("leaf") == F.col("f_leaf")))
    return joined.select(F.col("tree").alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


_ESCAPED = "length({0}) + (length({0}) - length(replace({0}, '\\', ''))) + (length({0}) - length(replace({0}, '#', ''))) + (length({0}) - length(replace({0}, '</', ''))) // 2"

OP2_SQL = f"""
WITH m AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + {_ESCAPED.format("role")} + (length(role) - length(replace(role, ':', ''))) + 2 + {_ESCAPED.format("text")} + 8) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = line_quality.line_quality(table(spark, sf_dir, "documents"))
    return quality.select("doc_id", *line_quality.COUNTS, "base_failed", "kept", "left_words")


def op4_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_topk.top_inner_products(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


def op5_token_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_prefix.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op6_credential_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credential_links.scan_credentials(table(spark, sf_dir, "documents"))


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_segments.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


# the tree of the mix: hosts fall into domains by their number, `src0` stands alone
MIX_LEVELS = {
    "domain": "CASE WHEN source = 'src0' THEN 'main' ELSE concat('side', regexp_extract(coalesce(source, ''), '([0-9]?)$', 1)) END",
    "lang": "lang",
    "source": "source",
}
MIX_WEIGHTS = ("CASE WHEN domain = 'main' THEN 50 ELSE 10 END", "CASE lang WHEN 'en' THEN 12 WHEN 'es' THEN 2 ELSE 3 END", "1")
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 90, 2, 7


def op10_weight_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weight_tree.mix(table(spark, sf_dir, "documents"), MIX_LEVELS, MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED)


def _share_sql(name: str, nodes: str, parent: str) -> str:
    """The water level of one level, as common table expressions ending in `{name}_b`."""
    part = f"PARTITION BY {parent}" if parent else ""
    order = f"ORDER BY CAST(capacity AS DOUBLE) / weight, {name}"
    keys = f"{parent}, {name}" if parent else name
    return f"""
{name}_a AS (SELECT *, coalesce(sum(capacity) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
  sum(weight) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM {nodes}),
{name}_f AS (SELECT *, capacity::HUGEINT * open_weight <= (budget_of - used)::HUGEINT * weight AS is_full FROM {name}_a),
{name}_l AS (SELECT *, budget_of - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER ({part}) AS remaining,
  greatest(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part}), 1) AS level_weight,
  coalesce(sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before FROM {name}_f),
{name}_b AS (SELECT {keys}, CAST(CASE WHEN is_full THEN capacity ELSE
  (remaining::HUGEINT * (w_before + weight)) // level_weight - (remaining::HUGEINT * w_before) // level_weight END AS BIGINT) AS budget FROM {name}_l)"""


def mix_sql(documents: str, percent: int, epochs: int, seed: int) -> str:
    """Common table expressions up to `taken`: doc_id, the levels, n_tokens, times."""
    return f"""
meta AS (SELECT doc_id,
  CASE WHEN source = 'src0' THEN 'main' ELSE 'side' || regexp_extract(coalesce(source, ''), '([0-9]?)$', 1) END AS domain,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens FROM {documents}),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM meta GROUP BY ALL),
tree AS (SELECT *, CASE WHEN domain = 'main' THEN 50 ELSE 10 END AS wd, CASE lang WHEN 'en' THEN 12 WHEN 'es' THEN 2 ELSE 3 END AS wl, 1 AS ws, tokens * {epochs} AS cap FROM leaves),
d0 AS (SELECT domain, CAST(sum(cap) AS BIGINT) AS capacity, max(wd) AS weight, (SELECT CAST(sum(tokens) AS BIGINT) * {percent} // 100 FROM leaves) AS budget_of FROM tree GROUP BY domain),
{_share_sql("domain", "d0", "")},
l0 AS (SELECT t.domain, t.lang, CAST(sum(cap) AS BIGINT) AS capacity, max(wl) AS weight, any_value(b.budget) AS budget_of FROM tree t JOIN domain_b b USING (domain) GROUP BY 1, 2),
{_share_sql("lang", "l0", "domain")},
s0 AS (SELECT t.domain, t.lang, t.source, CAST(sum(cap) AS BIGINT) AS capacity, max(ws) AS weight, any_value(b.budget) AS budget_of FROM tree t JOIN lang_b b USING (domain, lang) GROUP BY 1, 2, 3),
{_share_sql("source", "s0", "domain, lang")},
quotas AS (SELECT l.*, budget // greatest(tokens, 1) AS whole, budget % greatest(tokens, 1) AS rest FROM leaves l JOIN source_b USING (domain, lang, source)),
ordered AS (SELECT m.*, whole, rest, md5('{seed}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM meta m JOIN quotas USING (domain, lang, source)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY digest) AS upto FROM ordered),
taken AS (SELECT doc_id, domain, lang, source, n_tokens, whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS times FROM summed)"""


OP10_SQL = f"""
WITH {mix_sql("documents", MIX_PERCENT, MIX_EPOCHS, MIX_SEED)}
SELECT doc_id, domain, lang, source, n_tokens, CAST(unnest(range(CAST(times AS BIGINT))) AS INTEGER) AS epoch FROM taken
"""

def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by checksum, repeats its words from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    words = F.expr("regexp_extract_all(text, '[^\\\\x20\\\\x09-\\\\x0D]+', 0)")
    chosen = docs.select("doc_id", "text", F.when(checksum % 10 == 0, words).alias("words"), F.floor(checksum / 10).alias("g"))
    n = F.size("words")
    start = chosen.withColumn("a", F.when(n > 0, F.pmod(F.col("g"), n)))
    period = start.withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))))
    repeated = F.expr("array_join(transform(words, (w, i) -> IF(i < a, w, words[CAST(a + (i - a) % p AS INT)])), ' ')")
    return period.select("doc_id", F.when(F.col("p").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = word_runs.collapse_runs(with_planted_runs(docs))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    # runs come by start, then period; of runs with equal exponents the first one is taken
    best = F.expr("""aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
        (best, r) -> IF(best IS NULL OR r.length * best.period > best.length * r.period, r, best))""")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), with turns dropped, emptied, cut, repeated and renamed by checksum."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    damage = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), damage.alias("damage")
    ).filter("damage <> 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("damage") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    turns = turn_repair.numbered_turns(damaged_turns(conversations))
    edited = turn_repair.cut(turn_repair.edited_turns(turns))
    letters = F.concat(F.expr("repeat('I', length(before))"), "edit", F.expr("repeat('D', CAST(n - 1 AS INT))"), F.expr("repeat('I', length(ending))"))
    audits = edited.groupBy(F.col("conv_id").alias("a_id")).agg(
        F.max("cost").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", letters.alias("letters")))), lambda x: x.letters), "").alias("audit")
    )
    line = F.concat("role", F.lit(":"), "text")
    lines = F.array_sort(F.collect_list(F.struct("id", "place", line.alias("line"))))
    repaired = turn_repair.repaired_turns(edited).groupBy(F.col("conv_id").alias("r_id")).agg(F.sha2(F.array_join(F.transform(lines, lambda x: x.line), "\n"), 256).alias("repaired_sha256"))
    counts = turn_repair.repair_counts(turns).withColumnRenamed("conv_id", "n_id")
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for side, key in ((counts, "n_id"), (audits, "a_id"), (repaired, "r_id")):
        out = out.join(side, F.col("conv_id").eqNullSafe(F.col(key)), "left").drop(key)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    empty = F.sha2(F.lit(""), 256)
    return out.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


_CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ord(c)::BIGINT)),
  lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _edited_sql(state: str, cost: str, letter: str, line: str) -> str:
    """A state's best way {c, a, l} with one more edit."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'l': {state}.l || {line}}} END"


def _inserted_sql(ways: str) -> str:
    """conv_id, i and the states s0 to s3 out of the ways t0 to t3 of a subquery, with turns inserted."""
    user = ", ".join(_edited_sql(t, "3", "I", "'user:' || chr(10)") for t in ("t0", "t1", "t3"))
    assistant = _edited_sql("s2", "3", "I", "'assistant:' || chr(10)")
    return f"SELECT conv_id, i, s0, s1, s2, least(t3, {assistant}) AS s3 FROM (SELECT conv_id, i, t0 AS s0, t1 AS s1, least(t2, {user}) AS s2, t3 FROM ({ways}))"


def _turn_sql() -> str:
    """The best ways t0 to t3 after a turn `r`, from those before it."""
    own = "CASE WHEN r.fault = 'truncated' THEN 3 ELSE 0 END"
    user, assistant = "'user:' || r.text || chr(10)", "'assistant:' || r.text || chr(10)"
    kept = lambda s, kind: f"CASE WHEN r.live AND r.initial = '{kind}' THEN {_edited_sql(s, own, 'K', 'r.line || chr(10)')} END"
    reroled = lambda s, line: f"CASE WHEN r.live THEN {_edited_sql(s, '3 + ' + own, 'R', line)} END"
    gone = lambda s: _edited_sql(s, "4", "D", "''")
    to_user = ", ".join(f"{kept(s, 'u')}, {reroled(s, user)}" for s in ("s0", "s1", "s3"))
    return f"""{gone("s0")} AS t0, least({gone("s1")}, {kept("s0", "s")}) AS t1, least({gone("s2")}, {to_user}) AS t2,
      least({gone("s3")}, {kept("s2", "a")}, {reroled("s2", assistant)}) AS t3"""


OP12_SQL = f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32_SQL.format("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS damage FROM conversations),
d AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
    CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN damage = 3 THEN 2 ELSE 1 END))
  FROM c WHERE damage <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
n AS (
  SELECT *, role || ':' || text AS line, substring(role, 1, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
m AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS live, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM n),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND (before || initial) NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM m GROUP BY conv_id),
way AS (
  {_inserted_sql("SELECT conv_id, 0::BIGINT AS i, {'c': 0, 'a': '', 'l': ''} AS t0, " + ", ".join(f"CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, l VARCHAR)) AS t{k}" for k in (1, 2, 3)) + " FROM counts")}
  UNION ALL
  {_inserted_sql(f"SELECT r.conv_id, r.i, {_turn_sql()} FROM way w JOIN m r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1")}),
best AS (SELECT k.*, least(s0, s3) AS b FROM counts k JOIN way w ON k.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = k.n)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit,
  sha256(CASE WHEN coalesce(length(b.l), 0) > 0 THEN left(b.l, length(b.l) - 1) ELSE '' END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN best k ON o.conv_id IS NOT DISTINCT FROM k.conv_id
"""

URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, url, accepted): a page is labelled as the document whose number ends its path."""
    number = F.expr(r"try_cast(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '/([0-9]+)(?:[.]html)?/?$', 1) AS BIGINT)")
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    marks = labels.filter("quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(good).alias("accepted"))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", number.alias("number"))
    return pages.join(marks, F.col("number") == F.col("doc_id"), "left").select("page_id", "url", "accepted")


def op13_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = labelled_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return url_templates.judge_urls(pages, URL_RULES).drop("url")


_ESCAPED_SEGMENT = r"regexp_replace(segment, '([\\|*{}])', '\\\1', 'g')"


def _level_sql(level: int) -> str:
    """Templates t{level + 1} out of t{level}, as common table expressions."""
    k = level
    differ = f"""power(bad::DOUBLE * good_0 - bad_0 * good::DOUBLE, 2) * (good::DOUBLE + bad + good_0 + bad_0)
      > {url_templates.DIFFERENT} * (good::DOUBLE + bad) * (good_0 + bad_0) * (good + good_0) * (bad + bad_0)"""
    return f"""
s{k} AS (SELECT host, template, segments[{k + 1}] AS segment, sum(n) AS n, sum(good) AS good, sum(bad) AS bad FROM t{k} WHERE len(segments) > {k} GROUP BY ALL),
v{k} AS (SELECT *, sum(n) OVER (PARTITION BY host, template) AS all_n FROM s{k}),
f{k} AS (SELECT host, template, CASE WHEN n >= {url_templates.LEAST_ROWS} AND n * {url_templates.MOST_BRANCHES} >= all_n THEN segment END AS segment,
  sum(good) AS good, sum(bad) AS bad FROM v{k} GROUP BY ALL),
o{k} AS (SELECT *, row_number() OVER (PARTITION BY host, template ORDER BY (bad + 1.0::DOUBLE) / (good + bad + 2.0::DOUBLE), segment NULLS FIRST) AS i FROM f{k}),
l{k} AS (SELECT *, lag(good::DOUBLE) OVER (PARTITION BY host, template ORDER BY i) AS good_0, lag(bad::DOUBLE) OVER (PARTITION BY host, template ORDER BY i) AS bad_0 FROM o{k}),
g{k} AS (SELECT *, sum(CASE WHEN {differ} THEN 1 ELSE 0 END) OVER (PARTITION BY host, template ORDER BY i) AS grp FROM l{k}),
m{k} AS (SELECT host, template, unnest(list(segment)) AS segment, CASE WHEN bool_or(segment IS NULL) THEN '*' WHEN count(*) > 1
    THEN '{{' || string_agg({_ESCAPED_SEGMENT}, '|' ORDER BY {_ESCAPED_SEGMENT}) || '}}'
    ELSE any_value({_ESCAPED_SEGMENT}) END AS branch FROM g{k} GROUP BY host, template, grp),
t{k + 1} AS (SELECT t.* REPLACE (CASE WHEN len(segments) > {k} THEN t.template || '/' || coalesce(branch, '*') ELSE t.template END AS template)
  FROM t{k} t LEFT JOIN m{k} m ON t.host = m.host AND t.template = m.template AND t.segments[{k + 1}] = m.segment)"""


_URL_RULES_SQL = "VALUES " + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
OP13_SQL = f"""
WITH r(verdict, host, path) AS ({_URL_RULES_SQL}),
u AS (SELECT CAST(page_id AS BIGINT) AS page_id, url, CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
w AS (SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
  TRY_CAST(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '/([0-9]+)(?:[.]html)?/?$', 1) AS BIGINT) AS number FROM u),
k AS (SELECT doc_id, min(quality = 1 AND coalesce(toxic, 0) = 0) AS accepted FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
p AS (SELECT w.*, accepted FROM w LEFT JOIN k ON w.number = k.doc_id),
t0 AS (SELECT host, path, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template, count(*) AS n,
  count(*) FILTER (accepted) AS good, count(*) FILTER (NOT accepted) AS bad FROM p GROUP BY host, path),
{",".join(_level_sql(k) for k in range(url_templates.DEPTH))},
t AS (SELECT host, path, template || CASE WHEN len(segments) > {url_templates.DEPTH} THEN '/**' ELSE '' END AS template, good, bad FROM t{url_templates.DEPTH}),
a AS (SELECT host, template, sum(good) AS good, sum(bad) AS bad FROM t GROUP BY ALL),
h AS (SELECT host, (sum(good) + (SELECT (sum(good) + 1.0::DOUBLE) / (sum(good) + sum(bad) + 2.0::DOUBLE) FROM a) * {url_templates.SMOOTHING}) / (sum(good) + sum(bad) + {url_templates.SMOOTHING}::DOUBLE) AS share FROM a GROUP BY host),
y AS (SELECT a.host, template, (good + share * {url_templates.SMOOTHING}) / (good + bad + {url_templates.SMOOTHING}::DOUBLE) AS purity FROM a JOIN h USING (host))
SELECT p.page_id, p.host, p.path, b.rule, coalesce(b.verdict, CASE WHEN purity < {url_templates.LEAST_PURITY} THEN 'block' ELSE 'allow' END) AS verdict, t.template
FROM p JOIN t ON p.host = t.host AND p.path = t.path JOIN y ON t.host = y.host AND t.template = y.template
LEFT JOIN LATERAL (SELECT arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict FROM r
  WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) b ON true
"""

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_chat_trees": op2_chat_trees,
    "op3_line_quality": op3_line_quality,
    "op4_norm_topk": op4_norm_topk,
    "op5_token_prefix": op5_token_prefix,
    "op6_credential_links": op6_credential_links,
    "op7_fuzzy_lines": op7_fuzzy_lines,
    "op8_toxic_segments": op8_toxic_segments,
    "op9_histogram_packing": op9_histogram_packing,
    "op10_weight_tree": op10_weight_tree,
    "op11_word_runs": op11_word_runs,
    "op12_turn_repair": op12_turn_repair,
    "op13_url_templates": op13_url_templates,
}
ORACLE = {"op2_chat_trees": OP2_SQL, "op4_norm_topk": OP4_SQL, "op10_weight_tree": OP10_SQL, "op12_turn_repair": OP12_SQL, "op13_url_templates": OP13_SQL}
