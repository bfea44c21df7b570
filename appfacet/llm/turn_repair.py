"""Conversation structure repair: the cheapest edits that make turns alternate, by block tables.

The initials of the roles of a conversation shall read (s?(ua)+)?: nothing, or a system turn at
most, then pairs of a user and an assistant turn. Keeping a turn costs 0, giving it the role user
or assistant 3, deleting it 4, inserting an empty user or assistant turn 3; a truncated turn that
isn't deleted costs 3 more, and blank and repeated turns must go. Of the cheapest edits those are
taken whose initials (D, I, K, R in order) come first in ASCII.

The costs still to come, from each of the four states of the reading, differ by small amounts
only, so that there are few vectors of them once their least value is taken off. What a turn
does to each vector, and which edits it takes from each state, is worked out once, and composed
to tables over all blocks of BLOCK symbols (Four Russians). Turns are numbered in order over the
whole table, and each conversation falls into pieces of up to 2^PIECE_BITS turns. A piece looks its
blocks up from the last to the first, for all vectors that may follow it. Then a conversation's
pieces, one short row each, are put together from the last to the first, which gives the cost and
the vector behind each piece, and from the first to the last, which gives the state before it.
With both known, each piece expands its blocks backward to the vectors between its turns and
reads the edits forward, so that ties are decided as they would be over the whole conversation.
A conversation of n turns thus sends n / 2^PIECE_BITS rows to one task, and the edits are rows again.

Defined results: turns are taken by turn number, nulls first, then role, then text; a null role or
text is one space; a role's initial is its first character, and others than s, u, a are never
kept; equal turns with one number are counted, the first of them is the turn and the others
repeat it; a null conv_id is a conversation of its own; an empty table gives no rows; columns
beyond conv_id, turn, role, text are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appfacet.llm.common import cut, map_batches

#: states of the reading: nothing yet, after system, after user, after assistant; nothing and assistant may end
NEXT = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
ENDS = (0, 3)
N_STATES = 4
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: a turn's symbol: 0 must go, otherwise its kind and whether it is truncated
KINDS = "sua?"
N_SYMBOLS = 1 + 2 * len(KINDS)
BLOCK = 3
PIECE_BITS = 12
NAMES = {"u": "user", "a": "assistant"}
NONE = 1 << 30


def inserted(state: int) -> str:
    """The one turn that may be inserted in a state."""
    return "a" if state == 2 else "u"


def _after_inserts(costs: list[int]) -> tuple[int, ...]:
    """Least costs when turns may be inserted first; more than two lead back to a state."""
    out = list(costs)
    for _ in range(N_STATES):
        out = [min(c, INSERT + out[NEXT[inserted(s)][s]]) for s, c in enumerate(out)]
    return tuple(out)


def _ways(symbol: int, state: int) -> list[tuple[str, int, int, str]]:
    """(edit, cost, next state, role kind) of a turn, in ASCII order of the edits."""
    if symbol == 0:
        return [("D", 0, state, "")]  # must go: its cost is the same in any case and added at the end
    kind, truncated = KINDS[(symbol - 1) // 2], (symbol - 1) % 2 * TRUNCATED
    ways = [("D", DELETE, state, "")]
    if kind in NEXT and NEXT[kind][state] >= 0:
        ways.append(("K", truncated, NEXT[kind][state], kind))
    to = inserted(state)
    if to != kind:
        ways.append(("R", REROLE + truncated, NEXT[to][state], to))
    return ways


def before_turn(symbol: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs still to come before a turn, from those after it."""
    return _after_inserts([min(c + costs[to] for _, c, to, _ in _ways(symbol, s)) for s in range(N_STATES)])


class Tables:
    """All vectors of costs that can follow a turn, and what symbols and blocks of them do.

    `step[symbol]` has the vector before the symbol, the amount taken off, and the state that the
    edits lead to from each state, all by the vector after it; `block` the same by block.
    """

    def __init__(self):
        self.last = _after_inserts([0 if s in ENDS else NONE for s in range(N_STATES)])
        self.vectors = [self.last]
        known = {self.last: 0}
        rows: dict[tuple[int, int], tuple[int, int]] = {}
        for at, costs in enumerate(self.vectors):  # grows on the way
            for symbol in range(N_SYMBOLS):
                before = before_turn(symbol, costs)
                least = min(before)
                before = tuple(c - least for c in before)
                if before not in known:
                    known[before] = len(self.vectors)
                    self.vectors.append(before)
                rows[symbol, at] = known[before], least
        n = len(self.vectors)
        self.vector = np.array([[rows[s, v][0] for v in range(n)] for s in range(N_SYMBOLS)])
        self.cost = np.array([[rows[s, v][1] for v in range(n)] for s in range(N_SYMBOLS)])
        edits = [[[self._edit(s, v, state) for state in range(N_STATES)] for v in range(n)] for s in range(N_SYMBOLS)]
        self.edits = [[[(ins, edit, kind) for ins, edit, kind, _ in states] for states in row] for row in edits]
        self.state = np.array([[[x[3] for x in states] for states in row] for row in edits])
        block = self.vector, self.cost, self.state
        for _ in range(BLOCK - 1):
            block = self._longer(*block)
        self.block_vector, self.block_cost, self.block_state = block

    def _longer(self, vector, cost, state):
        """Tables of the blocks with one more symbol in front."""
        over = np.arange(vector.shape[1])[None, None, :, None]
        first = np.arange(N_SYMBOLS)[:, None, None]
        mid = np.broadcast_to(vector, (N_SYMBOLS, *vector.shape))
        moved = self.state[first, mid]  # the state after the first symbol, by block, vector, state
        tail = np.arange(vector.shape[0])[None, :, None, None]
        n = N_SYMBOLS * vector.shape[0]
        return (
            self.vector[first, mid].reshape(n, -1),
            (self.cost[first, mid] + cost).reshape(n, -1),
            state[tail, over, moved].reshape(n, -1, N_STATES),
        )

    def _edit(self, symbol: int, vector: int, state: int) -> tuple[str, str, str, int]:
        """(inserted kinds, edit, role kind, next state) at a turn, by the costs after it."""
        after = self.vectors[vector]
        before = before_turn(symbol, after)
        ins = ""
        while True:
            ways = {edit: (c, to, kind) for edit, c, to, kind in _ways(symbol, state)}
            best = [edit for edit, (c, to, _) in ways.items() if c + after[to] == before[state]]
            if best[:1] == ["D"]:
                return ins, "D", "", state
            to = NEXT[inserted(state)][state]
            if INSERT + before[to] == before[state]:
                ins += inserted(state)
                state = to
                continue
            _, to, kind = ways[best[0]]
            return ins, best[0], kind, to

    def ending(self, state: int) -> str:
        """The kinds inserted after the last turn."""
        out = ""
        while state not in ENDS:
            out += inserted(state)
            state = NEXT[inserted(state)][state]
        return out


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def blocks_of(symbols: bytes) -> list[int]:
    """Block numbers; the last block is filled up with symbols that do nothing."""
    filled = symbols + bytes(-len(symbols) % BLOCK)
    codes = np.frombuffer(filled, np.uint8).reshape(-1, BLOCK).astype(np.int64)
    return (codes @ (N_SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()


def piece_table(symbols: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vector before a piece, the cost, and the state after it from each state, by vector after it."""
    t = tables()
    n = len(t.vectors)
    vector, cost = np.arange(n), np.zeros(n, np.int64)
    state = np.tile(np.arange(N_STATES), (n, 1))
    over = np.arange(n)[:, None]
    for block in reversed(blocks_of(symbols)):
        state = state[over, t.block_state[block][vector]]
        cost += t.block_cost[block][vector]
        vector = t.block_vector[block][vector]
    return vector, cost, state


def piece_edits(symbols: bytes, vector: int, state: int) -> tuple[list[tuple[str, str, str]], int]:
    """(inserted kinds, edit, role kind) of each turn, and the state after the piece."""
    t = tables()
    blocks = blocks_of(symbols)
    behind = []  # the vector after each block
    for block in reversed(blocks):
        behind.append(vector)
        vector = t.block_vector[block][vector]
    out = []
    for at, after in zip(range(0, len(symbols), BLOCK), reversed(behind), strict=True):
        turns = symbols[at : at + BLOCK]
        between = [after]
        for symbol in reversed(turns[1:]):
            between.append(int(t.vector[symbol][between[-1]]))
        for symbol, v in zip(turns, reversed(between), strict=True):
            out.append(t.edits[symbol][v][state])
            state = int(t.state[symbol][v][state])
    return out, state


def _looked_up(batches):
    for b in batches:
        made = [piece_table(s) for s in b["symbols"]]
        yield {
            **{c: b[c] for c in ("conv_id", "piece")},
            "vectors": [v.astype(np.uint16).tobytes() for v, _, _ in made],
            "costs": [c.astype(np.int64).tobytes() for _, c, _ in made],
            "states": [s.astype(np.uint8).tobytes() for _, _, s in made],
        }


def _put_together(batches):
    t = tables()
    for b in batches:
        out = {c: [] for c in ("conv_id", "piece", "vector", "state", "cost", "is_last")}
        for conv_id, pieces in zip(b["conv_id"], b["pieces"], strict=True):
            vector, cost, behind = 0, 0, []
            for piece in reversed(pieces):
                behind.append(vector)
                cost += int(np.frombuffer(piece["costs"], np.int64)[vector])
                vector = int(np.frombuffer(piece["vectors"], np.uint16)[vector])
            cost += t.vectors[vector][0]
            state = 0
            for k, (piece, after) in enumerate(zip(pieces, reversed(behind), strict=True)):
                row = conv_id, piece["piece"], after, state, cost, k == len(pieces) - 1
                for name, value in zip(out, row, strict=True):
                    out[name].append(value)
                state = piece["states"][after * N_STATES + state]
        yield out


def _expanded(batches):
    t = tables()
    for b in batches:
        out = {c: [] for c in ("conv_id", "id", "before", "edit", "kind", "ending")}
        for conv_id, first, symbols, vector, state, is_last in zip(*(b[c] for c in ("conv_id", "first", "symbols", "vector", "state", "is_last")), strict=True):
            edits, state = piece_edits(symbols, vector, state)
            before, edit, kind = zip(*edits, strict=True)
            n = len(edits)
            ending = [""] * (n - 1) + [t.ending(state) if is_last else ""]
            for name, values in zip(out, ([conv_id] * n, range(first, first + n), before, edit, kind, ending), strict=True):
                out[name].extend(values)
        yield out


def has_word(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def numbered_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, id, turn, role, text, n, blank, again, truncated, symbol): turns in order of id.

    Equal turns are counted first, so that however many there are they are one row; and rows
    are dealt out in order of all columns, so that a conversation may take many tasks.
    """
    texts = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    turns = texts.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    said = F.sha2(F.concat("role", F.lit(":"), F.length("role").cast("string"), F.lit(":"), "text"), 256)
    turns = cut(turns.withColumn("said", said))
    # a null turn comes first, so minima take whether there is a turn before the turn itself
    firsts = turns.groupBy(F.col("conv_id").alias("f_conv"), F.col("said").alias("f_said")).agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    both = turns.join(firsts, F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("said") == F.col("f_said")))
    both = both.withColumn("is_first", F.col("turn").eqNullSafe(F.col("first.turn")))
    ordered = both.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    blank = ~has_word(F.col("text"))
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    kind = F.when(F.col("role").rlike(r"\A[sua]"), F.instr(F.lit(KINDS), F.substring("role", 1, 1)) - 1).otherwise(len(KINDS) - 1)
    live = F.col("is_first") & ~blank
    return cut(
        ordered.select(
            "conv_id",
            F.monotonically_increasing_id().alias("id"),
            "turn",
            "role",
            "text",
            "n",
            F.when(blank, F.col("n")).otherwise(0).alias("blank"),
            F.when(blank, 0).otherwise(F.col("n") - F.col("is_first").cast("int")).alias("again"),
            (live & truncated).cast("long").alias("truncated"),
            F.when(live, 1 + 2 * kind + truncated.cast("int")).otherwise(0).alias("symbol"),
        )
    )


def edited_turns(turns: DataFrame) -> DataFrame:
    """`turns` (of `numbered_turns`) with before, edit, kind, ending, cost.

    `before` and `ending` are the kinds of turns inserted before a turn and after the last one,
    `edit` what is done with the turn (its further copies are deleted), `kind` its role if it
    changes, `cost` that of its whole conversation.
    """
    piece = F.shiftright("id", PIECE_BITS).alias("piece")
    spelt = F.array_sort(F.collect_list(F.struct("id", "symbol")))
    pieces = turns.groupBy("conv_id", piece).agg(
        F.min("id").alias("first"),
        F.unhex(F.array_join(F.transform(spelt, lambda x: F.lpad(F.hex(x.symbol), 2, "0")), "")).alias("symbols"),
        (F.sum(F.col("blank") + F.col("again"))).alias("gone"),
    )
    pieces = cut(pieces)
    columns = {"conv_id": "long", "piece": "long", "vectors": "binary", "costs": "binary", "states": "binary"}
    looked = map_batches(pieces.select("conv_id", "piece", "symbols"), _looked_up, columns)
    listed = looked.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("piece", "vectors", "costs", "states"))).alias("pieces"))
    columns = {"conv_id": "long", "piece": "long", "vector": "int", "state": "int", "cost": "long", "is_last": "boolean"}
    known = cut(map_batches(listed, _put_together, columns))
    same = lambda a, b: F.col(f"{a}conv_id").eqNullSafe(F.col(f"{b}conv_id"))
    gone = pieces.groupBy("conv_id").agg(F.sum("gone").alias("all_gone")).withColumnRenamed("conv_id", "g_conv_id")
    known = known.join(gone, same("", "g_")).drop("g_conv_id")
    placed = pieces.withColumnsRenamed({"conv_id": "p_conv_id", "piece": "p_piece"}).join(known, same("", "p_") & (F.col("piece") == F.col("p_piece")))
    columns = {"conv_id": "long", "id": "long", "before": "string", "edit": "string", "kind": "string", "ending": "string"}
    edits = map_batches(placed.select("conv_id", "first", "symbols", "vector", "state", "is_last"), _expanded, columns)
    edits = edits.drop("conv_id").withColumnRenamed("id", "e_id")
    costs = known.filter("is_last").select(F.col("conv_id").alias("c_conv_id"), (F.col("cost") + DELETE * F.col("all_gone")).alias("cost"))
    edited = turns.join(edits, F.col("id") == F.col("e_id")).drop("e_id")
    return edited.join(costs, same("", "c_")).drop("c_conv_id")


def role_names(kinds: Column) -> Column:
    """The role names of inserted kinds."""
    return F.transform(F.split(kinds, ""), lambda k: F.when(k == "u", NAMES["u"]).when(k == "a", NAMES["a"]))


def repaired_turns(edited: DataFrame) -> DataFrame:
    """(conv_id, id, place, role, text): the turns of the repaired conversations, in order of id and place."""
    none = F.array().cast("array<struct<role:string,text:string>>")
    put = lambda kinds: F.when(F.length(kinds) > 0, F.transform(role_names(F.col(kinds)), lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))).otherwise(none)
    role = F.when(F.col("edit") == "R", F.when(F.col("kind") == "u", NAMES["u"]).otherwise(NAMES["a"])).otherwise(F.col("role"))
    own = F.when(F.col("edit") == "D", none).otherwise(F.array(F.struct(role.alias("role"), F.col("text").alias("text"))))
    listed = edited.select("conv_id", "id", F.posexplode(F.concat(put("before"), own, put("ending"))).alias("place", "turn"))
    return listed.select("conv_id", "id", "place", "turn.role", "turn.text")


def repair_counts(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal) per conversation of `turns`."""
    initial = F.substring("role", 1, 1)
    sides = turns.select("conv_id", "id", initial.alias("initial"), "n", F.shiftright("id", PIECE_BITS).alias("piece"))
    # neighbours within a piece, then the ends of neighbouring pieces
    spelt = F.array_sort(F.collect_list(F.struct("id", "initial", "n")))
    pieces = sides.groupBy("conv_id", "piece").agg(spelt.alias("spelt"))
    wrong = lambda a, b: (~F.concat(a, b).isin("su", "ua", "au")).cast("long")
    inside = F.aggregate(
        F.sequence(F.lit(2), F.size("spelt")),
        F.lit(0).cast("long"),
        lambda total, k: total + wrong(F.element_at("spelt", k - 1)["initial"], F.element_at("spelt", k)["initial"]),
    )
    pieces = pieces.select(
        "conv_id",
        "piece",
        (F.when(F.size("spelt") > 1, inside).otherwise(0) + F.aggregate("spelt", F.lit(0).cast("long"), lambda t, x: t + x.n - 1)).alias("inside"),
        F.col("spelt")[0]["initial"].alias("head"),
        F.element_at("spelt", -1)["initial"].alias("tail"),
    )
    ends = pieces.groupBy("conv_id").agg(F.sum("inside").alias("inside"), F.array_sort(F.collect_list(F.struct("piece", "head", "tail"))).alias("ends"))
    across = F.aggregate(
        F.sequence(F.lit(2), F.size("ends")), F.lit(0).cast("long"), lambda total, k: total + wrong(F.element_at("ends", k - 1)["tail"], F.element_at("ends", k)["head"])
    )
    illegal = ends.select(F.col("conv_id").alias("i_conv"), (F.col("inside") + F.when(F.size("ends") > 1, across).otherwise(0)).alias("illegal"))
    numbers = turns.groupBy("conv_id", "turn").agg(*(F.sum(c).alias(c) for c in ("blank", "again", "truncated")))
    counts = numbers.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"),
        F.sum("blank").alias("blank"),
        F.sum("again").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
    )
    return counts.join(illegal, F.col("conv_id").eqNullSafe(F.col("i_conv"))).drop("i_conv")
