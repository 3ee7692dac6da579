"""Chat formatting of reply trees (operator 3), built-in functions only.

Root-to-leaf paths come from iterative self-joins that double their reach: after k
rounds a leaf knows its 2**k nearest ancestors and every node the one 2**k above, so a
thread of thousands of turns takes a dozen small joins of ids; texts join in once, at the
end.  Branches of a tree are ranked by the sum of their nodes' scores.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  ``&`` and ``<|`` inside
texts and roles are written ``&amp;`` and ``&lt;|`` (and a line break in a role
``&#10;``), which no marker survives and which is undone exactly.  ``spans`` holds the
code-point range of every assistant text in the formatted string: the loss mask.

Cases: null texts and roles are empty; a null tree id is a tree of its own; a parent
that does not exist makes a root; nodes that never reach a root (a cycle) are in no
path; rows of one turn number are ordered by role and text; repeated rows are turns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollgraph.llm.store import materialise

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(column):
    return F.replace(F.replace(column, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(column):
    return F.replace(F.replace(column, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def linear_nodes(turns: DataFrame) -> DataFrame:
    """(tree, node, parent, role, text, score) of (conv_id, turn, role, text) rows:
    every conversation is a tree with one branch."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(
        F.col("conv_id").alias("tree"), "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def leaf_paths(links: DataFrame) -> tuple[DataFrame, int]:
    """(key, leaf, node, up) of (key, node, parent) rows: every node between a leaf
    and its root, ``up`` steps above the leaf; and the most nodes a path can have.
    Only a leaf that hangs on a cycle gets more nodes than that."""
    known = links.select("key", F.col("node").alias("parent"), F.lit(True).alias("known"))
    jump = links.where("parent IS NOT NULL").join(known, ["key", "parent"]).select("key", "node", F.col("parent").alias("above"))
    jump = materialise(jump, "chat-jump")
    inner = jump.select("key", F.col("above").alias("node")).distinct()
    paths = links.join(inner, ["key", "node"], "left_anti").select("key", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up"))
    paths = materialise(paths, "chat-paths")
    most = links.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    reach = 1
    while reach <= most and not jump.isEmpty():
        more = paths.join(jump, ["key", "node"]).select("key", "leaf", F.col("above").alias("node"), (F.col("up") + reach).alias("up"))
        paths = materialise(paths.unionByName(more), "chat-paths")
        upper = jump.select("key", F.col("node").alias("above"), F.col("above").alias("top"))
        jump = materialise(jump.join(upper, ["key", "above"]).select("key", "node", F.col("top").alias("above")), "chat-jump")
        reach *= 2
    return paths, most


def format_trees(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """(tree, leaf, rank, score, formatted, spans) of the ``branches`` best paths of
    each tree (all by default); ``nodes`` has tree, node, parent, role, text, score."""
    key = F.coalesce(F.concat(F.lit("="), F.col("tree").cast("string")), F.lit("-"))
    role = F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("&#10;"))
    rows = nodes.select(
        key.alias("key"), "tree", "node", "parent", role.alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), F.col("parent").isNull().alias("top"),
    )
    paths, most = leaf_paths(rows.select("key", "node", "parent"))
    turn = F.concat(F.lit(START), "role", F.lit("\n"), "text", F.lit(END))
    placed = paths.join(rows, ["key", "node"]).withColumn("turn", turn)
    order = Window.partitionBy("key", "leaf").orderBy(F.desc("up"))
    end = F.sum(F.char_length("turn")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - len(END)
    span = F.when(F.col("role") == "assistant", F.struct((end - F.char_length("text")).alias("start"), end.alias("end")))
    placed = placed.withColumn("span", span)
    turns = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "turn", "span")))
    grouped = placed.groupBy("key", "leaf").agg(F.first("tree").alias("tree"), F.sum("score").alias("score"), turns.alias("turns"))
    grouped = grouped.where(F.size("turns") <= most)
    best = Window.partitionBy("key").orderBy(F.desc("score"), "leaf")
    ranked = grouped.withColumn("rank", F.row_number().over(best))
    chosen = ranked if branches is None else ranked.where(F.col("rank") <= branches)
    return chosen.select(
        "tree", "leaf", "rank", "score",
        F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda x: x["span"]), lambda x: x.isNotNull()).alias("spans"),
    )


def read_turns(formatted):
    """The (role, text) pairs that a formatted string was made of."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    split = lambda x: F.instr(x, "\n") if isinstance(x, str) else F.locate("\n", x)

    def turn(x):
        at = split(x)
        role = unescape(F.replace(F.substring(x, F.lit(1), at - 1), F.lit("&#10;"), F.lit("\n")))
        text = F.substring(x, at + 1, F.char_length(x) - at - len(END))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted, spans):
    """The texts under the loss mask, unescaped."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
