import hashlib
import random
import re
import zlib
from itertools import product

import duckdb
import pytest

from appfacet.llm import turn_repair
from appfacet.llm.queries import OP12_SQL, op12_turn_repair

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(initials, live, truncated):
    """(cost, audit, [(row or None, initial)]) of the best edits, by keeping the best way to every state."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    ways = {"": (0, "", ())}

    def with_inserts(ways):
        for _ in range(3):
            for state, (cost, audit, kept) in [*ways.items()]:
                for to in after[state]:
                    if to != "s":
                        new = cost + 3, audit + "I", (*kept, (None, to))
                        ways[to] = min(ways.get(to, new), new, key=lambda w: w[:2])
        return ways

    ways = with_inserts(ways)
    for row, initial in enumerate(initials):
        following = {}
        for state, (cost, audit, kept) in ways.items():
            options = [(state, (cost + 4, audit + "D", kept))]
            if live[row]:
                own = 3 * truncated[row]
                for to in after[state]:
                    if to == initial:
                        options.append((to, (cost + own, audit + "K", (*kept, (row, "")))))
                    elif to != "s":
                        options.append((to, (cost + own + 3, audit + "R", (*kept, (row, to)))))
            for to, way in options:
                following[to] = min(following.get(to, way), way, key=lambda w: w[:2])
        ways = with_inserts(following)
    return min((ways[s] for s in ("", "a") if s in ways), key=lambda w: w[:2])


def brute(rows):
    out = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows}
    by_conv = {}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        damage = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        role = "user" if damage == 4 else role
        by_conv.setdefault(conv_id, []).extend([(turn, role, text)] * {0: 0, 3: 2}.get(damage, 1))
    for conv_id, turns in by_conv.items():
        if not turns:
            continue
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in turns:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[:1] for _, r, _ in turns]
        live = [f not in ("blank", "duplicate") for f in faults]
        cost, audit, kept = cheapest(initials, live, [f == "truncated" for f in faults])
        names = {"u": "user", "a": "assistant"}
        lines = [f"{names[to]}:" if row is None else f"{names.get(to) or turns[row][1]}:{turns[row][2]}" for row, to in kept]
        numbers = {t for t, _, _ in turns if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv_id] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return sorted(((k, *v) for k, v in out.items()), key=repr)


def conversations(rng, n, most=12):
    rows = []
    for conv_id in range(n):
        for turn in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No!", "What now?  ", "cut off", f"text {turn}.", "", " \n", None, "öäü. \t"])
            rows.append((conv_id, rng.choice([turn, turn, turn, turn + 3, None, turn // 2]), role, text))
    return rows


def answers(spark, rows, tmp_path, name="x"):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/{name}/conversations.parquet")
    out = op12_turn_repair(spark, f"{tmp_path}/{name}")
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_tables_give_the_best_edits_of_all_short_conversations():
    kinds = {0: ("u", False, False)} | {1 + 2 * k + t: (kind, True, bool(t)) for k, kind in enumerate("suax") for t in (0, 1)}
    for n in (1, 2, 3, 4):
        for symbols in product(range(turn_repair.N_SYMBOLS), repeat=n):
            vector, cost, state = turn_repair.piece_table(bytes(symbols))
            edits, end = turn_repair.piece_edits(bytes(symbols), 0, 0)
            audit = "".join("I" * len(ins) + edit for ins, edit, _ in edits) + "I" * len(turn_repair.tables().ending(end))
            assert end == state[0][0]
            total = cost[0] + turn_repair.tables().vectors[vector[0]][0] + 4 * symbols.count(0)
            initials, live, truncated = zip(*(kinds[s] for s in symbols), strict=True)
            assert (total, audit) == cheapest(initials, live, truncated)[:2]


def test_query_equals_plain_version(spark, tmp_path):
    rows = conversations(random.Random(3), 250)
    rows += [(None, 0, "user", "Hm."), (None, 1, "user", "Hm"), (None, None, None, None), (10**12, None, "user", "Hello."), (-5, 3, "assistant", "Bye.")]
    rows += [(999, t, "user" if t % 2 else "assistant", f"turn {t}.") for t in range(60)] + [(998, 4, "assistant", "Again.")] * 50
    assert answers(spark, rows, tmp_path) == brute(rows)


@pytest.mark.parametrize("bits", [1, 3])
def test_pieces_of_a_conversation_fit_together(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(turn_repair, "PIECE_BITS", bits)
    rng = random.Random(bits)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["ok", f"{t}!", ""])) for c in (1, 2, 3) for t in range(150)]
    assert answers(spark, rows, tmp_path) == brute(rows)


def test_sql_equals_plain_version(tmp_path):
    rows = conversations(random.Random(8), 120, 9)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted(connection.sql(OP12_SQL).fetchall(), key=repr) == brute(rows)


def test_empty_table_and_extra_columns(spark, tmp_path):
    from pyspark.sql import functions as F

    assert answers(spark, [], tmp_path) == []
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hi there.")]
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "edit": F.lit(1), "cost": F.lit(2), "n": F.lit(None).cast("int")})
    turns = turn_repair.numbered_turns(extra)
    (first, second) = turn_repair.edited_turns(turns).orderBy("id").collect()
    assert (first.edit, second.edit, first.cost) == ("K", "K", 0)


def test_equal_turns_are_one_row_and_a_conversation_takes_many_tasks(spark):
    rows = spark.range(20000).selectExpr("1L AS conv_id", "id % 5000 AS turn", "'user' AS role", "concat('text ', id % 5000, '.') AS text")
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = turn_repair.numbered_turns(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert turns.count() == 5000 and turns.agg({"again": "sum"}).first()[0] == 15000
    shares = [r["count"] for r in turns.groupBy(F.shiftright("id", 33)).count().collect()]
    assert len(shares) > 1 and max(shares) < 4000
