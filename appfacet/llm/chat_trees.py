"""Chat formatting of reply trees, with DataFrame functions only.

Root-to-leaf paths come from iterative self-joins that double their reach: after k rounds
each message knows its ancestor 2^k steps up and the score of the way there, so a path of
n messages takes log2(n) joins. Branches are ranked by their path's score; each chosen
path is written as one conversation, whose turns are marked and whose texts are escaped
so that no marker can occur in them, and comes with a loss mask.

Defined results: a null role or text is empty; a message whose parent isn't there is a
root; messages that no root reaches (cycles) are in no path; of messages with one id in
a tree the first by parent, role and text counts; ties between branches go to the
smaller leaf id; a null tree id is a tree of its own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from appfacet.llm.common import cut

TURN_END = "</turn>\n"
HEAD = "### "
SALTS = 16


def escape(text: Column) -> Column:
    """`text` with a backslash before backslashes, hash signs, colons and closing slashes of marks."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\#")), F.lit("</"), F.lit("<\\/"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _reach(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, total, steps) of the ways to the roots, and per round the messages that
    aren't there yet, as (tree, node, up, total, steps), each reaching twice as far.

    Only these are joined again, so that a round costs what the longer paths still need.
    """
    parents = nodes.select(F.col("tree").alias("p_tree"), F.col("node").alias("p_node"))
    there = F.col("tree").eqNullSafe(F.col("p_tree")) & (F.col("parent") == F.col("p_node"))
    state = cut(nodes.join(parents, there, "left").select("tree", "node", F.col("p_node").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("steps")))
    rounds = []
    for _ in range(max(1, nodes.count()).bit_length() + 1):  # beyond that only cycles go on
        below = state.filter("up IS NOT NULL")
        if below.isEmpty():
            break
        rounds.append(below)
        far = state.select(*(F.col(c).alias(f"far_{c}") for c in state.columns))
        on = F.col("tree").eqNullSafe(F.col("far_tree")) & (F.col("up") == F.col("far_node"))
        total, steps = F.col("total") + F.col("far_total"), F.col("steps") + F.col("far_steps")
        further = below.join(far, on).select("tree", "node", F.col("far_up").alias("up"), total.alias("total"), steps.alias("steps"))
        state = cut(state.filter("up IS NULL").unionByName(further))
    return state.filter("up IS NULL").drop("up"), rounds


def reply_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """Best paths of each tree: tree, leaf, position (from 0), role, text.

    `messages` has tree, node, parent, role, text and score; a null score counts 0.
    """
    nodes = messages.select("tree", "node", "parent", "role", "text", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    first = F.min_by(F.struct("parent", "role", "text", "score"), F.struct("parent", "role", "text", "score"))
    nodes = cut(nodes.filter("node IS NOT NULL").groupBy("tree", "node").agg(first.alias("m")).select("tree", "node", "m.*"))
    done, rounds = _reach(nodes)
    inner = nodes.select(F.col("tree").alias("c_tree"), F.col("parent").alias("c_parent")).filter("c_parent IS NOT NULL").distinct()
    is_parent = F.col("tree").eqNullSafe(F.col("c_tree")) & (F.col("node") == F.col("c_parent"))
    leaves = done.join(inner, is_parent, "left_anti")
    order = [F.desc("total"), F.asc("node")]
    some = Window.partitionBy("tree", F.pmod(F.xxhash64("node"), F.lit(SALTS))).orderBy(*order)
    rank = Window.partitionBy("tree").orderBy(*order)
    leaves = leaves.withColumn("r", F.row_number().over(some)).filter(F.col("r") <= best)
    leaves = leaves.withColumn("r", F.row_number().over(rank)).filter(F.col("r") <= best)
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", "steps", F.lit(0).cast("long").alias("back"))
    for k, below in enumerate(rounds):
        up = below.select(F.col("tree").alias("u_tree"), F.col("node").alias("u_node"), "up")
        on = F.col("tree").eqNullSafe(F.col("u_tree")) & (F.col("node") == F.col("u_node"))
        step = paths.join(up, on).select("tree", "leaf", F.col("up").alias("node"), "steps", (F.col("back") + F.lit(1 << k)).alias("back"))
        paths = cut(paths.unionByName(step))
    said = nodes.select(F.col("tree").alias("n_tree"), F.col("node").alias("n_node"), "role", "text")
    return paths.join(said, F.col("tree").eqNullSafe(F.col("n_tree")) & (F.col("node") == F.col("n_node"))).select(
        "tree", "leaf", (F.col("steps") - 1 - F.col("back")).alias("position"), "role", "text"
    )


def format_paths(paths: DataFrame, trained: str = "assistant") -> DataFrame:
    """One conversation per path: tree, leaf, formatted, mask.

    `mask` has an entry per turn: code points [start, end) of its text, and whether the
    loss counts there, which it does for turns of the role `trained`.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(HEAD), F.replace(escape(role), F.lit(":"), F.lit("\\:")), F.lit(": "))
    turns = paths.select("tree", "leaf", "position", head.alias("head"), escape(text).alias("body"), (role == trained).alias("loss"))
    turns = turns.withColumn("turn", F.concat("head", "body", F.lit(TURN_END)))
    before = Window.partitionBy("tree", "leaf").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)) + F.length("head")
    turns = turns.withColumn("start", start).withColumn("end", F.col("start") + F.length("body"))
    listed = turns.groupBy("tree", "leaf").agg(F.array_sort(F.collect_list(F.struct("position", "turn", "start", "end", "loss"))).alias("turns"))
    return listed.select(
        "tree",
        "leaf",
        F.array_join(F.col("turns.turn"), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t.start.alias("start"), t.end.alias("end"), t.loss.alias("loss"))).alias("mask"),
    )


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """Turns read back from `format_paths`: tree, leaf, position, role, text, loss_text (null outside the mask)."""
    ends = F.split("formatted", TURN_END)
    zipped = F.arrays_zip(F.slice(ends, F.lit(1), F.size(ends) - 1).alias("turn"), F.col("mask").alias("mask"))
    turns = formatted.select("tree", "leaf", F.posexplode(zipped).alias("position", "at")).select("tree", "leaf", "position", "at.turn", "at.mask")
    before = Window.partitionBy("tree", "leaf").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("turn") + F.lit(len(TURN_END))).over(before), F.lit(0))
    turns = turns.withColumn("offset", offset)
    head = F.regexp_extract("turn", r"(?s)^### ((?:[^\\:]|\\.)*): ", 1)
    under = F.substring("turn", (F.col("mask.start") - F.col("offset") + 1).cast("int"), (F.col("mask.end") - F.col("mask.start")).cast("int"))
    body = F.substring("turn", F.length(head) + F.lit(len(HEAD) + 3), F.length("turn"))
    return turns.select(
        "tree",
        "leaf",
        "position",
        unescape(head).alias("role"),
        unescape(body).alias("text"),
        F.when(F.col("mask.loss"), unescape(under)).alias("loss_text"),
    )
