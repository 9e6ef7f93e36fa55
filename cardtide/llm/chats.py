"""Format the branches of reply trees as conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardtide.llm.common import stored

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
# Control strings of common templates begin with one of these; in a text both are spelt out.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))
LEARNT_ROLE = "assistant"


def escape(text: Column, more: tuple = ()) -> Column:
    for plain, spelt in (*ESCAPES, *more):
        text = F.replace(text, F.lit(plain), F.lit(spelt))
    return text


def unescape(text: Column, more: tuple = ()) -> Column:
    for plain, spelt in reversed((*ESCAPES, *more)):
        text = F.replace(text, F.lit(spelt), F.lit(plain))
    return text


LINE_END = (("\n", "&nl;"),)


def linear_tree(messages: DataFrame) -> DataFrame:
    """Messages in a row as a tree in which each replies to the one before.

    ``messages(conv_id, turn, role, text)`` to ``tree, node, parent, role, text, score``.
    Rows go by turn, equal turns by role, then text. Null conversations are one tree.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = messages.select(
        F.col("conv_id").alias("tree"),
        F.row_number().over(order).cast("long").alias("node"),
        "role",
        "text",
    )
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(
        "tree", "node", parent.alias("parent"), "role", "text", F.lit(1.0).alias("score")
    )


def format_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The ``branches`` best root-to-leaf paths of each tree, each as one conversation.

    ``messages(tree, node, parent, role, text, score)``: ``(tree, node)`` is a
    message's key, ``parent`` the node it replies to in the same tree (null: a root, as
    is a node whose parent is missing). A branch's score is the sum of its messages'
    (null counts 0); ties go to the smaller leaf. Result: ``tree, leaf, score, n_turns,
    formatted, mask``, ``mask`` an array of ``(start, end)`` code points that cover the
    (escaped) texts of the assistant. Null roles and texts are empty. No rows, no
    result. A repeated ``(tree, node)`` counts once, by the smallest role and text;
    rows without a node, and messages that reply in a circle, stand on no branch.

    Paths are enumerated by self-joins that double the reach each time: ancestors at
    distance 1, 2, 4, ... so a tree of depth d takes log d joins. Only the leaves are
    walked back, so the rows made are those of the paths. Trees of any width spread
    over the tasks, since rows go by (tree, node); ranking keeps the best before rows move.
    """
    nodes = (
        messages.filter(F.col("node").isNotNull())
        .groupBy("tree", "node")
        .agg(
            F.min(
                F.struct(
                    F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"),
                    "parent",
                    F.coalesce("score", F.lit(0.0)).alias("score"),
                )
            ).alias("m")
        )
        .select(F.struct("tree", "node").alias("id"), "tree", "node", "m.*")
    )
    nodes = stored(nodes, "messages")
    replies = nodes.filter(F.col("parent").isNotNull()).select(
        "id", F.struct("tree", F.col("parent").alias("node")).alias("up")
    )
    replies = stored(replies.join(nodes.select(F.col("id").alias("up")), "up", "left_semi"), "up")

    jumps, most = [replies], nodes.count()
    while not jumps[-1].isEmpty():
        last = jumps[-1]
        if 1 << len(jumps) > 2 * most:
            # Only a circle goes on for longer than there are messages.
            jumps = [j.join(last.select("id"), "id", "left_anti") for j in jumps[:-1]]
            nodes = nodes.join(last.select("id"), "id", "left_anti")
            break
        onward = last.select(F.col("id").alias("up"), F.col("up").alias("upper"))
        jumps.append(stored(last.join(onward, "up").select("id", F.col("upper").alias("up")), "up"))

    has_reply = replies.select(F.col("up").alias("id"))
    leaves = nodes.join(has_reply, "id", "left_anti")
    path = leaves.select(F.col("id").alias("leaf"), "id", F.lit(0).cast("long").alias("back"))
    for power in reversed(range(len(jumps))):
        # One row stays and one goes up: an explode, so that the path so far is read once.
        here = F.struct("id", "back")
        above = F.struct(F.col("up").alias("id"), (F.col("back") + (1 << power)).alias("back"))
        step = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))
        path = path.join(jumps[power], "id", "left").select("leaf", F.explode(step).alias("s"))
        path = path.select("leaf", "s.id", "s.back")
    path = stored(path, "paths")

    scores = (
        path.join(nodes.select("id", "score"), "id")
        .groupBy("leaf")
        .agg(F.sum("score").alias("score"))
    )
    best = Window.partitionBy("leaf.tree").orderBy(F.desc("score"), "leaf.node")
    chosen = scores.withColumn("_rank", F.row_number().over(best)).filter(
        F.col("_rank") <= branches
    )
    turns = (
        path.join(chosen.select("leaf", F.col("score").alias("branch_score")), "leaf")
        .join(nodes.select("id", "role", "text"), "id")
        .select(
            "leaf",
            "branch_score",
            F.struct(
                (-F.col("back")).alias("place"),
                F.concat(F.lit(OPEN), escape(F.col("role"), LINE_END), F.lit("\n")).alias("head"),
                escape(F.col("text")).alias("text"),
                (F.col("role") == LEARNT_ROLE).alias("learnt"),
            ).alias("turn"),
        )
    )
    before = (
        Window.partitionBy("leaf").orderBy("turn.place").rowsBetween(Window.unboundedPreceding, -1)
    )
    size = F.length("turn.head") + F.length("turn.text") + len(CLOSE)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("turn.head")
    span = F.struct(
        start.cast("long").alias("start"), (start + F.length("turn.text")).cast("long").alias("end")
    )
    placed = turns.withColumn("span", F.when(F.col("turn.learnt"), span))
    listed = placed.groupBy("leaf", "branch_score").agg(
        F.sort_array(F.collect_list("turn")).alias("turns"),
        F.sort_array(F.collect_list("span")).alias("mask"),
    )
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(CLOSE)))
    return listed.select(
        F.col("leaf.tree").alias("tree"),
        F.col("leaf.node").alias("leaf"),
        F.col("branch_score").alias("score"),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(pieces, "").alias("formatted"),
        "mask",
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``(role, text)``."""
    parts = F.split(formatted, "<\\|turn\\|>")
    segments = F.slice(parts, F.lit(2), F.size(parts) - 1)

    def turn(segment):
        parts = F.split(segment, "\n", 2)
        body = parts[1]
        text = F.substring(body, F.lit(1), F.length(body) - len(CLOSE))
        return F.struct(
            unescape(parts[0], LINE_END).alias("role"), unescape(text).alias("text")
        )

    return F.transform(segments, turn)


def learnt_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, with nothing between."""
    parts = F.transform(
        mask,
        lambda s: unescape(
            F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return F.array_join(parts, "")
