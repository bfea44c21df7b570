import random
from collections import defaultdict

import pytest

from appfacet.llm import url_templates
from appfacet.llm.queries import URL_RULES, op13_url_templates
from appfacet.llm.url_templates import DEPTH, DIFFERENT, LEAST_PURITY, LEAST_ROWS, MOST_BRANCHES, SMOOTHING

PAGES, LABELS = "page_id long, url string, html string", "doc_id long, quality int, toxic int"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
    host, path = rest[:cut], rest[cut:]
    for c in "?#":
        path = path.split(c)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fitting = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fitting)[1:] if fitting else (None, None)


def escaped(segment):
    return "".join("\\" + c if c in "\\|*{}" else c for c in segment)


def grow(rows, level, template, out):
    """Templates of the rows (segments, key, good, bad) of one node."""
    for segments, key, *_ in rows:
        if len(segments) <= level:
            out[key] = template
        elif level == DEPTH:
            out[key] = template + "/**"
    rows = [r for r in rows if len(r[0]) > level]
    if level == DEPTH or not rows:
        return
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[0][level]] += r[2]
    often = {s for s, n in sizes.items() if n >= LEAST_ROWS and n * MOST_BRANCHES >= sum(sizes.values())}
    branches = defaultdict(list)
    for r in rows:
        branches[r[0][level] if r[0][level] in often else None].append(r)
    counted = [(b, sum(r[3] for r in x), sum(r[4] for r in x)) for b, x in branches.items()]
    counted.sort(key=lambda c: ((c[2] + 1) / (c[1] + c[2] + 2), c[0] is not None, (c[0] or "").encode()))
    groups, last = [], None
    for b, good, bad in counted:
        if last and not (bad * last[0] - last[1] * good) ** 2 * (good + bad + sum(last)) > DIFFERENT * (good + bad) * sum(last) * (good + last[0]) * (bad + last[1]):
            groups[-1].append(b)
        else:
            groups.append([b])
        last = good, bad
    for group in groups:
        name = "*" if None in group else escaped(group[0]) if len(group) == 1 else "{" + "|".join(sorted(map(escaped, group))) + "}"
        grow([r for b in group for r in branches[b]], level + 1, f"{template}/{name}", out)


def brute(pages, labels):
    marks = defaultdict(list)
    for doc_id, quality, toxic in labels:
        if quality is not None:
            marks[doc_id].append(quality == 1 and not toxic)
    urls = defaultdict(lambda: [0, 0, 0])
    for _, url in pages:
        bare = (url or "").split("?")[0].split("#")[0].rstrip("/") if not (url or "").split("?")[0].split("#")[0].endswith("//") else ""
        tail = bare.rsplit("/", 1)[-1].removesuffix(".html") if "/" in bare else ""
        label = min(marks[int(tail)]) if tail.isascii() and tail.isdigit() and int(tail) in marks else None
        count = urls[parts(url)]
        count[0] += 1
        if label is not None:
            count[1 if label else 2] += 1
    hosts = defaultdict(list)
    for (host, path), count in urls.items():
        hosts[host].append(([s for s in path.split("/") if s], path, *count))
    good, bad = sum(c[1] for c in urls.values()), sum(c[2] for c in urls.values())
    share, templates, verdicts = (good + 1) / (good + bad + 2), {}, {}
    for host, rows in hosts.items():
        out = {}
        grow(rows, 0, "", out)
        of_host = (sum(r[3] for r in rows) + share * SMOOTHING) / (sum(r[3] + r[4] for r in rows) + SMOOTHING)
        sums = defaultdict(lambda: [0, 0])
        for r in rows:
            sums[out[r[1]]][0] += r[3]
            sums[out[r[1]]][1] += r[4]
        for r in rows:
            g, b = sums[out[r[1]]]
            templates[host, r[1]] = out[r[1]]
            verdicts[host, r[1]] = "block" if (g + of_host * SMOOTHING) / (g + b + SMOOTHING) < LEAST_PURITY else "allow"
    rows = []
    for page_id, url in pages:
        key = parts(url)
        rule, verdict = rule_of(*key)
        rows.append((page_id, *key, rule, verdict or verdicts[key], templates[key]))
    return sorted(rows, key=repr)


def write(spark, tmp_path, pages, labels):
    spark.createDataFrame([(*p, "x") for p in pages], PAGES).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    return op13_url_templates(spark, str(tmp_path))


def corpus():
    rng = random.Random(5)
    pages = []
    for i in range(3000):
        host = rng.choice(["big.example.net"] * 4 + ["Shop.Example.ORG", "x.de", "a.com", "example.org"])
        top = rng.choice(["en", "de", "fr", "es", "spam", "wiki", "a|b", "{x}", "rare" + str(i)])
        deep = "/".join(rng.choice(["p", "q", str(i % 7)]) for _ in range(rng.choice([0, 1, 1, 2, 9])))
        pages.append((i, rng.choice(["http", "https"]) + f"://{host}/{top}/{deep}{'/' if deep else ''}{i}" + rng.choice(["", "/", ".html", "?q=1/2", "#a/b"])))
    pages += [(5000, None), (5001, ""), (5002, "no scheme/x"), (5003, "http://"), (5004, "x://h?p/1"), (5005, "http://org/en/1"), (5006, "http://EXAMPLE.org"), (None, "http://a.com/de/9")]
    pages += [(6000 + i, "http://hot.net/same/7") for i in range(400)] + [(7, pages[7][1])]
    labels = [(i, int(rng.random() > (0.9 if "/spam/" in u else 0.4 if "/wiki/" in u else 0.1)), rng.choice([0, 0, 0, None, 1])) for i, u in pages[:3000] if rng.random() < 0.6]
    labels += [(3, None, None), (None, 1, 0), (8, 0, 0), (8, 1, 1)]
    return pages, labels


def test_query_equals_plain_version(spark, tmp_path):
    pages, labels = corpus()
    out = write(spark, tmp_path, pages, labels)
    assert out.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    rows = sorted((tuple(r) for r in out.collect()), key=repr)
    assert rows == brute(pages, labels)
    by_template = {(r[1], r[5]): r[4] for r in rows if r[3] is None}
    assert by_template["big.example.net", "/spam/*"] == "block"
    assert len({t for h, t in by_template if h == "big.example.net"}) < 60


def test_contract_of_hosts_and_rules(spark):
    urls = {
        "http://A.Example.ORG/es/5": ("a.example.org", "/es/5", "example.org/es/", "block"),
        "http://example.org/en/12?x": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "ftp://x.com/de/#": ("x.com", "/de/", "com/de/", "block"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://org?a://b/c": ("org", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    from pyspark.sql import functions as F

    pages = spark.createDataFrame([(u,) for u in urls], "url string").withColumns({"accepted": F.lit(None).cast("boolean"), "host": F.lit(1), "j_host": F.lit("x"), "purity": F.lit(2)})
    out = url_templates.judge_urls(pages, URL_RULES)
    assert out.columns == ["url", "j_host", "purity", "host", "path", "rule", "verdict", "template"]
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in out.collect()} == urls


def test_no_rows(spark, tmp_path):
    assert write(spark, tmp_path, [], []).collect() == []


@pytest.mark.parametrize("bad", [0, 100])
def test_variable_segments_become_wildcards_and_different_ones_stay_apart(spark, bad):
    rows = [(f"http://h.net/{'ok' if i % 2 else 'no'}/user{i}/home", i % 2 == 1 or i >= 2 * bad) for i in range(400)]
    pages = spark.createDataFrame(rows, "url string, accepted boolean")
    found = {(r.template, r.verdict) for r in url_templates.judge_urls(pages, []).collect()}
    assert found == ({("/{no|ok}/*/home", "allow")} if not bad else {("/no/*/home", "block" if bad > 100 else "allow"), ("/ok/*/home", "allow")})


def test_paths_use_no_python_workers(spark):
    pages = spark.createDataFrame([("http://h.net/a/b", True)], "url string, accepted boolean")
    plan = url_templates.judge_urls(pages, URL_RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
