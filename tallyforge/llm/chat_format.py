"""Reply trees to training conversations, with DataFrame functions only.

Nodes (conv_id, node_id, parent_id, role, text, score) form trees. Every root-to-leaf path is found
by self-joins that double the jump each time, so a path of n turns takes log2(n) rounds. Branches of
a conversation are ranked by the sum of their scores, and each chosen path becomes one string:

    <|im_start|>role\\ntext<|im_end|>\\n ...

Every control string of the template starts with ``<|``. Inside roles and texts ``~`` becomes ``~0``
and ``<|`` becomes ``<~1|`` (and a newline in a role ``~2``), which ``unescape`` reverses, so no text
can open or close a turn. ``loss_spans`` (start, length in code points) covers assistant texts.

Defined cases: rows with a null conv_id are one conversation; rows with a null node_id are no nodes; conv_id is an
integer; null text or role is empty; texts and conversations of any length are whole; other columns are not returned; a null score is 0; a parent that is null or absent makes
a root; nodes on or below a cycle belong to no path; repeated (conv_id, node_id) rows: the least
(parent_id, role, text) stays; equal scores: the smaller leaf id wins; an empty table gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.shared import saved

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit("<|"), F.lit("<~1|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("~2"), F.lit("\n")), F.lit("~1"), F.lit("")), F.lit("~0"), F.lit("~"))


def tree_paths(nodes: DataFrame) -> DataFrame:
    """(conv_id, leaf, node_id, up): the nodes of every root-to-leaf path, ``up`` steps above the leaf."""
    ids = nodes.select("conv_id", "node_id", "parent_id")
    links = saved(ids.join(ids.select("conv_id", F.col("node_id").alias("parent_id")), ["conv_id", "parent_id"], "left_semi").select("conv_id", "node_id", F.col("parent_id").alias("above")))
    leaves = ids.join(links.select("conv_id", F.col("above").alias("node_id")), ["conv_id", "node_id"], "left_anti")
    paths = leaves.select("conv_id", F.col("node_id").alias("leaf"), "node_id", F.lit(0).cast("long").alias("up"))
    most = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1
    jump = links
    for k in range(math.ceil(math.log2(most)) if most > 1 else 0):
        paths = saved(paths.unionByName(paths.join(jump, ["conv_id", "node_id"]).select("conv_id", "leaf", F.col("above").alias("node_id"), (F.col("up") + 2**k).alias("up"))))
        jump = saved(jump.join(jump.select("conv_id", F.col("node_id").alias("above"), F.col("above").alias("top")), ["conv_id", "above"]).select("conv_id", "node_id", F.col("top").alias("above")))
    # A node still linked after that many steps hangs on a cycle.
    return paths.join(jump.select("conv_id", F.col("node_id").alias("leaf")), ["conv_id", "leaf"], "left_anti") if most > 1 else paths


def format_trees(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """One row for each of the ``keep`` best branches of a conversation:
    conv_id, leaf, branch_rank, branch_score, n_turns, formatted, loss_spans."""
    # Joins need ids that are equal to themselves.
    stand_in = (nodes.agg(F.min("conv_id")).first()[0] or 0) - 1
    nodes = nodes.withColumn("conv_id", F.coalesce(F.col("conv_id").cast("long"), F.lit(stand_in)))
    one = Window.partitionBy("conv_id", "node_id").orderBy("parent_id", "role", "text", "score")
    nodes = nodes.select("conv_id", "node_id", "parent_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    nodes = nodes.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")
    paths = tree_paths(nodes).join(nodes.select("conv_id", "node_id", "score"), ["conv_id", "node_id"])
    best = Window.partitionBy("conv_id").orderBy(F.desc("branch_score"), "leaf")
    chosen = paths.groupBy("conv_id", "leaf").agg(F.sum("score").alias("branch_score")).withColumn("branch_rank", F.row_number().over(best)).where(F.col("branch_rank") <= keep)
    turns = paths.drop("score").join(chosen, ["conv_id", "leaf"]).join(nodes.drop("score", "parent_id"), ["conv_id", "node_id"])
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("~2")), F.lit("\n"))
    turns = turns.withColumns({"head": head, "body": escape(F.col("text"))}).withColumn("piece", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("conv_id", "leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("piece")).over(before), F.lit(0)) + F.length("head"))
    span = F.when(F.col("role") == "assistant", F.struct(F.col("at").alias("start"), F.length("body").cast("long").alias("length")))
    rows = turns.groupBy("conv_id", "leaf").agg(
        F.first("branch_rank").alias("branch_rank"), F.first("branch_score").alias("branch_score"), F.count("*").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "piece"))).alias("pieces"), F.sort_array(F.collect_list(span)).alias("loss_spans"),
    )
    conv_id = F.when(F.col("conv_id") != stand_in, F.col("conv_id")).alias("conv_id")
    formatted = F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("formatted")
    return rows.select(conv_id, "leaf", "branch_rank", "branch_score", "n_turns", formatted, "loss_spans")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted string."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.substr(p, F.lit(len(START) + 1)))
    return F.transform(bodies, lambda b: F.struct(unescape(F.substring_index(b, "\n", 1)).alias("role"), unescape(F.substr(b, F.length(F.substring_index(b, "\n", 1)) + 2)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def linear_nodes(turns: DataFrame) -> DataFrame:
    """Rows by turn as trees of one branch: each turn answers the one before it."""
    at = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select("conv_id", F.row_number().over(at).cast("long").alias("node_id"), "role", "text").select("conv_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))
