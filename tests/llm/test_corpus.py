"""Operators that compare rows with each other, and the pipeline, against plain versions."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from appfacet.llm import chat_trees, fuzzy_lines, graph, line_quality, ngram_join, norm_topk, weight_tree
from appfacet.llm.queries import MIX_LEVELS, MIX_PERCENT, MIX_WEIGHTS, conversation_messages

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def join_components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, join_components(sets, links)


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"e{seed}q{k}" if rng.random() < share else w for k, w in enumerate(text.split(" ")))


def near_copies(prose, seed=0):
    rows = [prose(seed + i, 40 + 7 * i) for i in range(12)]
    base = prose(seed + 99, 150).replace("\n", " ")
    rows += [edited(base, seed + k, 0.004 * (k % 12)) for k in range(90)] + [base] * 5
    passage = prose(seed + 50, 70)
    rows += [passage + " " + prose(seed + 200 + k, 60) for k in range(50)]
    rows += [None, "", " \n", "a b", "A B", "a b c", "É x", "é x", "one two three four five", "one  two\tthree four FIVE", "w " * 4000]
    return rows


@pytest.mark.parametrize("seed", [0, 1000])
def test_components_are_those_of_all_pairs(documents, prose, seed):
    rows = list(enumerate(near_copies(prose, seed)))
    random.Random(seed).shuffle(rows)
    sizes, want = brute_components(rows)
    out = ngram_join.jaccard_components(documents(rows, extra=("v", "n", "component"))).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == {i: (sizes[i], want[i]) for i, _ in rows}
    assert 1 < len(set(want.values())) < len(rows)


def test_sets_that_pivots_leave_out_still_meet(documents, prose, monkeypatch):
    """A chain of edits: neighbours link, far ones don't; small chunks and no frequent order."""
    monkeypatch.setattr(ngram_join, "CHUNK", 7)
    words = prose(5, 200).split()
    rows = []
    for k in range(40):
        words = words[:]
        for j in range(3):
            words[(k * 15 + 5 * j) % 200] = f"n{k}j{j}"
        rows.append((k, " ".join(words)))
    sizes, want = brute_components(rows)
    out = ngram_join.jaccard_components(documents(rows)).collect()
    assert {r.doc_id: r.component_id for r in out} == want


def test_one_of_each_component_stays(documents, prose):
    base = prose(1, 100)
    rows = [(3, base), (1, base + " more"), (1, base + " more"), (None, base), (5, None), (6, ""), (6, ""), (7, prose(2)), (7, prose(3))]
    frame = documents(rows, extra=("row_key", "empty"))
    out = ngram_join.one_of_each(frame)
    assert out.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([(1, base + " more"), (5, None), (6, ""), (6, ""), (7, prose(2)), (7, prose(3))], key=repr)
    assert ngram_join.jaccard_components(documents([])).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 120)]
    loose = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)]
    edges = chain + star + loose
    rng.shuffle(edges)
    want = join_components({i for e in edges if e[0] != e[1] for i in e}, edges)
    out = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.id: r.component for r in out.collect()} == want


def test_id_filters_hold_all_their_ids(spark):
    ids = np.array([random.Random(k).randrange(-(2**63), 2**63) for k in range(300)], np.int64)
    bits = graph.id_filter(spark.createDataFrame([(int(i),) for i in ids], "v long"), "v")
    assert graph.passes(bits, ids).all()
    others = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)
    assert graph.passes(bits, others).mean() < 0.05


LETTERS = str.maketrans("0123456789", "bdfhjkmpqz")


def within_edits(a, b, most):
    """Whether a and b are within `most` edits, by the band of the table that can tell."""
    if abs(len(a) - len(b)) > most:
        return False
    row = {j: j for j in range(min(len(b), most) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            ways = [row.get(j, most + 1) + 1, new.get(j - 1, most + 1) + 1]
            if j:
                ways.append(row.get(j - 1, most + 1) + (x != b[j - 1]))
            new[j] = i if not j else min(ways)
        if min(new.values()) > most:
            return False
        row = new
    return row.get(len(b), most + 1) <= most


def brute_lines(rows):
    """(doc, text) after dedup, by the edit similarity of all pairs of distinct lines."""
    first, words = {}, {}
    place = lambda doc: (doc is not None, doc or 0)
    for doc_id, text in rows:
        for key, w in fuzzy_lines.worded_lines(text):
            words[key] = w
            first[key] = min(first.get(key, doc_id), doc_id, key=place)
    keys = sorted(words)
    text = {k: b" ".join(words[k]).decode() for k in keys if len(words[k]) >= 5}
    most = lambda a, b: int(max(len(text[a]), len(text[b])) * 0.1)
    links = [(a, b) for a, b in combinations(sorted(text), 2) if within_edits(text[a], text[b], most(a, b))]
    group = join_components(keys, links)
    best = {}
    for k in keys:
        best[group[k]] = min(best.get(group[k], k), k, key=lambda k: (place(first[k]), k))
    stay = {}
    for hi, lo in best.values():
        stay.setdefault(first[hi, lo], []).append(hi.to_bytes(8, "big", signed=True) + lo.to_bytes(8, "big", signed=True))
    return sorted(((doc_id, fuzzy_lines.kept_text(text, stay.get(doc_id))) for doc_id, text in rows), key=repr), links


def test_fuzzy_lines_are_those_of_all_pairs(documents, prose):
    rng = random.Random(4)
    letters = lambda *of, **how: prose(*of, **how).translate(LETTERS)
    shared = [letters(i, 40, per_line=40) for i in range(15)]
    rows = []
    for doc_id in range(60):
        lines = [letters(1000 + doc_id, 12), "short line", "Page 12 of the whole long list", ""]
        for line in rng.sample(shared, 4):
            words = line.split(" ")
            if rng.random() < 0.6:
                words[rng.randrange(40)] += "z"
            lines.append(" ".join(words))
        rows.append((doc_id, "\n".join(lines)))
    rows += [(90, None), (91, ""), (92, rows[3][1]), (93, "one two three four five\n" * 3), (94, "x " * 20000), (None, rows[5][1]), (95, "  \n\t")]
    frame = documents(rows, extra=("kept", "in_doc", "line", "hi", "size"))
    want, links = brute_lines(rows)
    out = fuzzy_lines.dedup_lines(frame)
    assert out.columns == frame.columns
    got = out.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == want
    assert links and all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)
    assert fuzzy_lines.dedup_lines(documents([])).count() == 0


def test_null_ids_come_first(documents):
    line = "one two three four five six"
    out = fuzzy_lines.dedup_lines(documents([(1, line), (None, line + "\nshort"), (2, line)]))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == [(1, ""), (2, ""), (None, line + "\nshort")]


def test_blocks_meet_all_lines_within_two_bits(spark):
    rng = np.random.default_rng(8)
    base = rng.integers(-(2**63), 2**63 - 1, (40, 2))
    flips = np.zeros((3, 40, 2), np.int64)
    for copy in flips:
        for _ in range(2):
            copy[np.arange(40), rng.integers(0, 2, 40)] ^= np.int64(1) << rng.integers(0, 64, 40)
    sims = np.concatenate([base, *(base ^ f for f in flips)])
    unsigned = np.ascontiguousarray(sims).view(np.uint64)
    differ = lambda i, j: int(np.bitwise_count(unsigned[i] ^ unsigned[j]).sum())
    want = {(i, j) for i, j in combinations(range(len(sims)), 2) if differ(i, j) <= 2}
    keys = rng.integers(-(2**63), 2**63 - 1, (len(sims), len(fuzzy_lines.PACKED)))  # no piece in common
    rows = [(i, 100, 100, *map(int, sims[i]), *map(int, keys[i])) for i in range(len(sims))]
    lines = spark.createDataFrame(rows, "line long, size int, bytes int, sim0 long, sim1 long, " + ", ".join(f"{c} long" for c in fuzzy_lines.PACKED))
    met = {}
    for r in fuzzy_lines.met_lines(lines).collect():
        met.setdefault(r.key, set()).add(r.line)
    assert want and want <= {p for group in met.values() for p in combinations(sorted(group), 2)}


def test_signatures_are_those_of_the_definition():
    rng = random.Random(2)
    lines = [bytes(rng.choice(b"abcd efg") for _ in range(n)) for n in (1, 5, 6, 7, 40, 57, 63, 70, 71, 90, 600, 3000)]
    together = fuzzy_lines.Pieces(lines)
    keys, sims = together.keys(), together.simhashes()
    for i, line in enumerate(lines):
        alone = fuzzy_lines.Pieces([line])
        assert (alone.keys() == keys[i]).all() and (alone.simhashes() == sims[i]).all()
        hashes = alone.hashes(False, np.array([0]))[0]
        chosen = hashes[(hashes >> np.uint64(63) == 0) | (np.arange(len(hashes)) == 0)]
        ones = np.unpackbits(fuzzy_lines.mix(chosen).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=int)
        assert (np.packbits(2 * ones > len(chosen), bitorder="little").view(np.int64)[0] == sims[i][0]).all()


def brute_topk(vectors, k, every):
    v = {}
    for i, x in vectors:
        if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x):
            v.setdefault(i, [int(np.floor(256 * float(np.float32(c)))) for c in x])
    out = []
    for q in v:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q and len(v[c]) == len(v[q]))
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_products_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(norm_topk, "BLOCK", 64)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, 24)) * rng.exponential(size=(500, 1)) * (0.8 ** np.arange(24))
    vectors = [(i, [float(c) for c in row]) for i, row in enumerate(x.astype(np.float32))]
    vectors += [(600 + i, vectors[7][1]) for i in range(30)]  # ties
    vectors += [(700, None), (750, [1.0, None]), (800, [float("nan")] * 24), (850, [float("inf")] * 24), (900, [0.0] * 24), (950, [1.0, 2.0]), (951, [3.0, 4.0]), (1000, [])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<float>, group string").repartition(4)
    out = norm_topk.top_inner_products(frame, k=5, every=50)
    assert sorted(tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect()) == brute_topk(vectors, 5, 50)
    assert norm_topk.top_inner_products(frame.limit(0)).count() == 0


def tree_rows():
    """Trees with branches: (tree, node, parent, role, text, score)."""
    rng, out = random.Random(9), []
    for tree in [*range(12), None]:
        for node in range(rng.randrange(1, 40)):
            parent = None if node == 0 or rng.random() < 0.05 else rng.randrange(max(0, node - 4), node)
            text = rng.choice([None, "", "hi", "### x: y", "\\### Assistant: </turn> ok", "a\nb\\", "</turn>\n", "漢<"])
            out.append((tree, node, parent, rng.choice(["user", "assistant", "a:b#\\", None]), text, rng.choice([None, 1.0, 2.0, -1.0])))
    out += [(50, 1, 2, "user", "loop", 1.0), (50, 2, 1, "user", "loop", 1.0), (51, 5, 99, "user", "orphan", 1.0)]
    return out + out[:3]


def brute_paths(rows, best):
    trees = {}
    for tree, node, parent, role, text, score in dict.fromkeys(rows):
        trees.setdefault(tree, {})[node] = (parent, role, text, score or 0.0)
    out = {}
    for tree, nodes in trees.items():
        leaves = []
        for leaf in set(nodes) - {n[0] for n in nodes.values()}:
            path, at = [], leaf
            while at in nodes:
                path.append(at)
                at = nodes[at][0]
            leaves.append((-sum(nodes[n][3] for n in path), leaf, path[::-1]))
        for _, leaf, path in sorted(leaves)[:best]:
            out[tree, leaf] = [(nodes[n][1] or "", nodes[n][2] or "") for n in path]
    return out


@pytest.mark.parametrize("best", [1, 3])
def test_best_paths_survive_formatting(spark, best):
    rows = tree_rows()
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double").repartition(3)
    want = brute_paths(rows, best)
    formatted = chat_trees.format_paths(chat_trees.reply_paths(frame, best)).collect()
    assert {(r.tree, r.leaf) for r in formatted} == set(want)
    for r in formatted:
        turns = want[r.tree, r.leaf]
        assert r.formatted.count("</turn>\n") == len(turns)
        under = [re.sub(r"(?s)\\(.)", r"\1", r.formatted[m.start : m.end]) for m in r.mask if m.loss]
        assert under == [text for role, text in turns if role == "assistant"]
    read = {}
    for r in chat_trees.parse_conversations(spark.createDataFrame(formatted)).collect():
        read.setdefault((r.tree, r.leaf), []).append((r.position, r.role, r.text, r.loss_text))
    assert {k: [(a, b) for _, a, b, _ in sorted(v)] for k, v in read.items()} == want
    assert all((loss == text) if role == "assistant" else loss is None for v in read.values() for _, role, text, loss in v)


def test_conversations_become_chains(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(300)] + [(2, 0, "user", None), (2, 0, "user", "same turn")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    paths = chat_trees.reply_paths(conversation_messages(frame)).collect()
    assert {t: sum(r.tree == t for r in paths) for t in (1, 2, -7)} == {1: 300, 2: 2, -7: 2}
    assert sorted(r.position for r in paths if r.tree == 1) == [*range(300)]


def water(children, budget):
    """Shares of (name, capacity, weight) by raising the level until the budget is used."""
    left, open_, out = min(budget, sum(c for _, c, _ in children)), sorted(children, key=lambda x: (x[1] / x[2], x[0])), {}
    while open_ and open_[0][1] * sum(w for *_, w in open_) <= left * open_[0][2]:
        name, capacity, _ = open_.pop(0)
        out[name] = capacity
        left -= capacity
    total, before = sum(w for *_, w in open_), 0
    for name, _, w in open_:
        out[name] = left * (before + w) // total - left * before // total
        before += w
    return out


def brute_mix(rows, percent, epochs, seed):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    leaves = {}
    for doc_id, text, lang, source in rows:
        domain = "main" if source == "src0" else "side" + re.search("([0-9]?)$", source or "").group(1)
        leaves.setdefault((domain, lang or "", source or ""), []).append((doc_id, words(text)))
    tokens = {leaf: sum(n for _, n in docs) for leaf, docs in leaves.items()}
    weight = [lambda x: 50 if x[0] == "main" else 10, lambda x: {"en": 12, "es": 2}.get(x[1], 3), lambda x: 1]
    budgets = {(): sum(tokens.values()) * percent // 100}
    for level in range(3):
        following = {}
        for parent, budget in budgets.items():
            children = {leaf[: level + 1] for leaf in leaves if leaf[:level] == parent}
            sized = [(c[-1], epochs * sum(n for leaf, n in tokens.items() if leaf[: level + 1] == c), weight[level](c)) for c in children]
            following |= {(*parent, name): b for name, b in water(sized, budget).items()}
        budgets = following
    out = []
    for leaf, docs in leaves.items():
        whole, rest = divmod(budgets[leaf], max(1, tokens[leaf]))
        out += [(d, n, e) for d, n in docs for e in range(whole)]
        used = 0
        order = {}
        for d, n in docs:
            order.setdefault(hashlib.md5(f"{seed}:{whole}:{'' if d is None else d}".encode()).hexdigest(), []).append((d, n))
        for digest in sorted(order):
            used += sum(n for _, n in order[digest])
            if rest > 0 and used <= rest:
                out += [(d, n, whole) for d, n in order[digest]]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("percent", "epochs"), [(90, 2), (40, 1), (300, 2)])
def test_mix_fills_the_tree_as_planned(documents, prose, percent, epochs):
    rng, rows = random.Random(percent), []
    for i in range(250):
        rows.append((i, prose(i, rng.randrange(1, 80)), rng.choice(["en", "en", "de", "es", None]), rng.choice(["src0"] * 4 + ["src1", "src2", "src12", None, ""])))
    rows += [(300, None, "en", "src0"), (301, "", "xx", "src77"), (5, rows[5][1], rows[5][2], rows[5][3])]
    frame = documents(rows, extra=("domain", "whole"))
    got = weight_tree.mix(frame.drop("domain"), MIX_LEVELS, MIX_WEIGHTS, percent, epochs).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.epoch) for r in got), key=repr) == brute_mix(rows, percent, epochs, 7)


def test_mix_once_keeps_columns_and_both_joins_agree(documents, prose, monkeypatch):
    rows = [(i, prose(i, 10 + i % 50), "en" if i % 3 else "de", f"src{i % 5}") for i in range(150)]
    frame = documents(rows, extra=("whole", "leaf", "salt_"))
    want = sorted(r.doc_id for r in weight_tree.mix_once(frame, MIX_LEVELS, MIX_WEIGHTS, 60).collect())
    monkeypatch.setattr(weight_tree, "MOST_BROADCAST_LEAVES", 0)
    out = weight_tree.mix_once(frame, MIX_LEVELS, MIX_WEIGHTS, 60)
    assert out.columns == frame.columns and sorted(r.doc_id for r in out.collect()) == want
    assert want == sorted(d for d, _, _ in brute_mix(rows, 60, 1, 7))
    assert weight_tree.mix_once(documents([]), MIX_LEVELS, MIX_WEIGHTS, 60).count() == 0


def test_pipeline_stages_equal_plain_ones(spark, documents, prose, tmp_path):
    rng = random.Random(1)
    letters = lambda *of: prose(*of).translate(LETTERS)
    base, rows = letters(77, 160).replace("\n", " "), []
    for i in range(80):
        rows.append((i, letters(i, 60 + i), rng.choice(["en", "de"]), rng.choice(["src0", "src0", "src1", "src2"])))
    rows += [(100 + k, edited(base, k, 0.01), "en", "src1") for k in range(12)] + [(200 + k, rows[k][1], "en", "src2") for k in range(5)]
    rows += [(300, "too short", "en", "src1"), (301, "spam spam spam " * 40, "en", "src1"), (302, None, "en", "src0"), (303, "", "de", "src0")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = {r[0]: r[1] for r in rows}
    source = {r[0]: r for r in rows}
    # quality: nothing is frequent here, so the base rules decide
    counts = {i: line_quality.text_counts(t) for i, t in docs.items()}
    docs = {i: t for i, t in docs.items() if counts[i][0] >= 50 and 100 * counts[i][4] <= 50 * counts[i][0]}
    assert 300 not in docs and 301 not in docs
    docs = {i: t for i, t in brute_lines([*docs.items()])[0] if t.split()}
    component = brute_components([*docs.items()])[1]
    docs = {i: t for i, t in docs.items() if component[i] == i}
    kept = {d for d, _, _ in brute_mix([(i, t, *source[i][2:]) for i, t in docs.items()], MIX_PERCENT, 1, 7)}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    from tests.llm.test_texts import check_packing

    assert {r.doc_id for r in out} == kept
    names = sorted(kept)
    place = {d: k for k, d in enumerate(names)}
    used, least = check_packing([docs[d] for d in names], [r.__class__(**(r.asDict() | {"doc_id": place[r.doc_id]})) for r in out], 4096)
    assert used <= least + 1
    assert len({zlib.crc32(docs[d].encode()) for d in kept}) == len(kept)
