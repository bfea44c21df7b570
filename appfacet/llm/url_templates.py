"""URL filters: rules by host and path, and for the other URLs the purity of path templates.

The paths of a host form a tree of their segments, which is generalised from its root on. A
segment value that fewer than LEAST_ROWS URLs of its node have, or less than one in MOST_BRANCHES,
is variable, and all such values share the wildcard branch; a node so keeps MOST_BRANCHES values at
most, however many there are. Then branches whose labels don't differ are merged: ordered by their
smoothed share of rejected URLs, neighbours stay apart only if a chi-square test of their counts
tells them apart. The branches a URL takes make its template. A template's purity is its share of
accepted labels, smoothed by that of its host, and this by that of all URLs; templates of less than
LEAST_PURITY are rejected. Only built-in functions are used, and URLs with one host and path are
one row from the start, so that a URL repeated however often is counted before it is shuffled.

Defined results: a null URL, or one without `://`, has an empty host and path; equal URLs get equal
verdicts; empty segments are passed over, and segments beyond DEPTH are one wildcard `**`; without
any label all URLs without a rule are allowed; of rules of one length that fit the first one is
taken; an empty table gives no rows; further columns of the table stay, but for host, path, rule,
verdict and template, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appfacet.llm.common import cut, free_name

LEAST_ROWS, MOST_BRANCHES = 20, 50
#: chi-square of one degree of freedom at 5 %
DIFFERENT = 3.84
#: labels that a host's share counts for in its templates, and that of all URLs in a host
SMOOTHING = 10
LEAST_PURITY = 0.5
DEPTH = 8
WILDCARD, DEEPER = "*", "**"
RESULTS = ("host", "path", "rule", "verdict", "template")


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting one of the rules (verdict, host, path) as a struct (rule, verdict), else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _branches(paths: DataFrame, level: int) -> DataFrame:
    """(host, template, segment, branch): the values of a level that have a branch besides the wildcard."""
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    values = paths.groupBy("host", "template", F.get("segments", F.lit(level)).alias("segment")).agg(*sums)
    nodes = values.groupBy(F.col("host").alias("n_host"), F.col("template").alias("n_template")).agg(*(F.sum(c).alias(f"all_{c}") for c in ("n", "good", "bad")))
    same = (F.col("host") == F.col("n_host")) & (F.col("template") == F.col("n_template"))
    # few values remain of each node; written out, so that the join of a large node can be split
    often = values.filter(F.col("n") >= LEAST_ROWS).join(nodes, same).filter(F.col("n") * MOST_BRANCHES >= F.col("all_n"))
    often = cut(often.select("host", "template", "segment", "n", "good", "bad"))
    sums = often.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "good", "bad")))
    others = nodes.join(sums, same, "left").filter(F.col("all_n") > F.coalesce("n", F.lit(0)))
    left = lambda c: (F.col(f"all_{c}") - F.coalesce(c, F.lit(0))).alias(c)
    wild = others.select(F.col("n_host").alias("host"), F.col("n_template").alias("template"), F.lit(None).cast("string").alias("segment"), left("good"), left("bad"))
    found = often.drop("n").unionByName(wild)
    node = Window.partitionBy("host", "template")
    by_share = node.orderBy((F.col("bad") + 1.0) / (F.col("good") + F.col("bad") + 2.0), F.col("segment").asc_nulls_first())
    count = lambda c: F.col(c).cast("double")
    found = found.withColumns({"good_0": F.lag(count("good")).over(by_share), "bad_0": F.lag(count("bad")).over(by_share)})
    total, total_0 = count("good") + count("bad"), count("good_0") + count("bad_0")
    apart = count("bad") * count("good_0") - count("bad_0") * count("good")
    differ = apart * apart * (total + total_0) > F.lit(DIFFERENT) * total * total_0 * (count("good") + count("good_0")) * (count("bad") + count("bad_0"))
    merged = found.withColumn("group", F.sum(F.when(differ, 1).otherwise(0)).over(by_share.rowsBetween(Window.unboundedPreceding, 0)))
    # a node has at most MOST_BRANCHES values here
    group = Window.partitionBy("host", "template", "group")
    spelt = F.array_join(F.sort_array(F.collect_list(F.regexp_replace("segment", r"([\\|*{}])", r"\\$1")).over(group)), "|")
    several = F.count("*").over(group) > 1
    branch = F.when(F.max(F.col("segment").isNull()).over(group), WILDCARD).when(several, F.concat(F.lit("{"), spelt, F.lit("}"))).otherwise(spelt)
    return merged.select("host", "template", "segment", branch.alias("branch")).filter(F.col("segment").isNotNull() & (F.col("branch") != WILDCARD))


def path_templates(paths: DataFrame) -> DataFrame:
    """`paths` (host, path, n, good, bad), one row for each, with its template."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    paths = cut(paths.select("host", "path", "n", "good", "bad", segments.alias("segments"), F.lit("").alias("template")))
    deepest = paths.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(deepest, DEPTH)):
        live = F.size("segments") > level
        branches = _branches(paths.filter(live), level).withColumnsRenamed({"host": "b_host", "template": "b_template", "segment": "b_segment"})
        same = (F.col("host") == F.col("b_host")) & (F.col("template") == F.col("b_template")) & (F.get("segments", F.lit(level)) == F.col("b_segment"))
        further = F.concat("template", F.lit("/"), F.coalesce("branch", F.lit(WILDCARD)))
        paths = paths.join(branches, same, "left").withColumn("template", F.when(live, further).otherwise(F.col("template")))
        paths = cut(paths.drop("b_host", "b_template", "b_segment", "branch"))
    template = F.when(F.size("segments") > DEPTH, F.concat("template", F.lit(f"/{DEEPER}"))).otherwise(F.col("template"))
    return paths.withColumn("template", template).drop("segments")


def template_purity(templates: DataFrame) -> DataFrame:
    """(host, template, good, bad, purity) of the templates of `templates` (host, template, good, bad)."""
    counted = templates.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    hosts = counted.groupBy(F.col("host").alias("h_host")).agg(F.sum("good").alias("h_good"), F.sum("bad").alias("h_bad"))
    everything = hosts.agg(((F.coalesce(F.sum("h_good"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("h_good") + F.sum("h_bad"), F.lit(0)) + 2.0)).alias("share"))
    share = everything.scalar()
    smooth = lambda good, bad, towards: (F.col(good) + towards * SMOOTHING) / (F.col(good) + F.col(bad) + float(SMOOTHING))
    hosts = hosts.select("h_host", smooth("h_good", "h_bad", share).alias("h_share"))
    both = counted.join(hosts, F.col("host") == F.col("h_host"))
    return both.select("host", "template", "good", "bad", smooth("good", "bad", F.col("h_share")).alias("purity"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], accepted: str = "accepted") -> DataFrame:
    """`pages` (url, and a boolean column with the label or null) with host, path, rule, verdict, template.

    Labels count whether or not a rule decides about their URL; the label column is left out.
    """
    kept = [c for c in pages.columns if c.lower() != accepted.lower() and c.lower() not in RESULTS]
    url, label = free_name(pages, "the_url"), free_name(pages, "the_label")
    rows = pages.select(*kept, F.col("url").alias(url), F.col(accepted).alias(label))
    rows = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    counts = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count_if(F.col(label)).alias("good"), F.count_if(~F.col(label)).alias("bad")
    )
    templates = path_templates(counts)
    purity = template_purity(templates).select(F.col("host").alias("p_host"), F.col("template").alias("p_template"), "purity")
    judged = templates.join(purity, (F.col("host") == F.col("p_host")) & (F.col("template") == F.col("p_template")))
    side = judged.select(F.col("host").alias(j_host := free_name(rows, "j_host")), F.col("path").alias(j_path := free_name(rows, "j_path")), "template", F.col("purity").alias(pure := free_name(rows, "purity")))
    out = rows.join(side, (F.col("host") == F.col(j_host)) & (F.col("path") == F.col(j_path)))
    out = out.withColumn(rule := free_name(out, "fitting"), longest_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col(pure) < LEAST_PURITY, "block").otherwise("allow")
    return out.select(*kept, "host", "path", F.col(rule)["rule"].alias("rule"), F.coalesce(F.col(rule)["verdict"], own).alias("verdict"), "template")
