"""Chat formatting: reply trees to the best-scored paths, each formatted as one conversation.

Only DataFrame functions. Paths are found with ids alone: the step table, a node's ancestor with the sum of the scores
on the way, is joined with itself, doubling the distance each round, so a path of n turns takes log2(n) rounds and every
node on it at most one row in each. That ranks the leaves; only the chosen paths are then written out node by node, by the same steps.
Texts are joined once, to the chosen paths.

The template writes a turn as ``### role: text</turn>`` and a line break. Inside texts and roles a backslash is
written ``\\b``, ``#`` is ``\\h``, ``<`` is ``\\l``, and a colon in a role is ``\\c``. So no control string can
occur inside a turn, and ``unescape`` gives the text back exactly.

Defined results: NULL role and text count as empty; a NULL tree id is a tree of its own; a parent that does
not exist makes its child a root; of repeated node ids the smallest (parent, role, text) counts; nodes on a
cycle have no root and are on no path; NULL scores count 0; ties go to the longer path, then the smaller leaf
id. An empty table gives no rows. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import drop_tables, materialise, null_safe_key

HEAD, COLON, END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    """``text`` without ``#`` and ``<``, reversibly."""
    out = F.replace(text, F.lit("\\"), F.lit("\\b"))
    out = F.replace(out, F.lit("#"), F.lit("\\h"))
    return F.replace(out, F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The text that ``escape`` was given."""
    out = F.replace(text, F.lit("\\l"), F.lit("<"))
    out = F.replace(out, F.lit("\\h"), F.lit("#"))
    return F.replace(out, F.lit("\\b"), F.lit("\\"))


def chain_nodes(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees without branches: each turn answers the one before.

    Repeated turn numbers are ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    nodes = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node_id"))
    parent = F.when(F.col("node_id") > 1, F.col("node_id") - 1)
    return nodes.select("conv_id", "node_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def best_paths(nodes: DataFrame, best: int) -> tuple[DataFrame, DataFrame]:
    """The ``best`` root-to-leaf paths of each tree by total score, and the nodes they refer to.

    ``nodes``: conv_id, node_id, parent_id, role, text, score. The paths have a row for each turn:
    (tree, leaf, node, pos, path_rank, path_score), pos from 0 at the root.
    """
    first = F.min_by(
        F.struct("conv_id", "parent_id", "role", "text", "score"),
        F.struct("parent_id", F.coalesce("role", F.lit("")).alias("r"), F.coalesce("text", F.lit("")).alias("t")),
    )
    keyed = nodes.select(
        null_safe_key(F.col("conv_id")).alias("tree"), F.col("node_id").alias("node"), "conv_id", "parent_id",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    ).where("node IS NOT NULL")
    keyed = keyed.groupBy("tree", "node").agg(first.alias("row")).select("tree", "node", "row.*")
    keyed = materialise(keyed, "chat-nodes")
    ids = keyed.select("tree", "node", "parent_id", "score")
    known = ids.select("tree", F.col("node").alias("to"), F.lit(True).alias("known"))
    # A node's path up to, but without, the node that ``to`` names; above the root there is none.
    step = ids.withColumnRenamed("parent_id", "to").join(known, ["tree", "to"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("to")).alias("to"), F.col("score").alias("sum"), F.lit(1).cast("long").alias("turns"))
    step = materialise(step, "chat-steps")
    leaves = ids.select("tree", "node").join(step.where("to IS NOT NULL").select("tree", F.col("to").alias("node")), ["tree", "node"], "left_anti")
    largest = ids.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    steps, done, distance = [step], step.where("to IS NULL"), 1
    # A path holds at most every node of its tree once; only a cycle could go on beyond that. A round only takes nodes
    # that have not come to the root; those that have keep the sum of their whole path.
    while distance < largest:
        going = step.where("to IS NOT NULL")
        if going.isEmpty():
            break
        above = (done.unionByName(going)).select(
            "tree", F.col("node").alias("to"), F.col("to").alias("far"), F.col("sum").alias("more"), F.col("turns").alias("further"))
        step = materialise(going.join(above, ["tree", "to"]).select(
            "tree", "node", F.col("far").alias("to"), (F.col("sum") + F.col("more")).alias("sum"),
            (F.col("turns") + F.col("further")).alias("turns")), "chat-steps")
        steps.append(step)
        done = done.unionByName(step.where("to IS NULL"))
        distance *= 2
    # Leaves are ranked by the sums of their paths, one row each, before any path is written out.
    rank = Window.partitionBy("tree").orderBy(F.desc("sum"), F.desc("turns"), "node")
    chosen = done.join(leaves, ["tree", "node"]).withColumn("path_rank", F.row_number().over(rank))
    chosen = chosen.where(F.col("path_rank") <= best).select(
        "tree", F.col("node").alias("leaf"), "node", (F.col("turns") - 1).alias("pos"), "path_rank", F.col("sum").alias("path_score"))
    paths, distance = materialise(chosen, "chat-paths"), 1
    for hop in steps[:-1] if len(steps) > 1 else []:
        hops = hop.where("to IS NOT NULL").select("tree", "node", "to")
        further = paths.join(hops, ["tree", "node"]).select(
            "tree", "leaf", F.col("to").alias("node"), (F.col("pos") - distance).alias("pos"), "path_rank", "path_score")
        last, paths = paths, materialise(paths.unionByName(further), "chat-paths")
        drop_tables(nodes.sparkSession, last)
        distance *= 2
    drop_tables(nodes.sparkSession, *steps)
    return paths, keyed


def format_paths(paths: DataFrame, nodes: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per path: conv_id, path_rank, path_score, formatted, loss_mask.

    ``loss_mask`` lists (start, length), in code points of ``formatted``, of the texts of ``loss_role``.
    """
    role = F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\c"))
    turns = paths.join(nodes.select("tree", "node", "conv_id", "role", "text"), ["tree", "node"]).select(
        "tree", "leaf", "conv_id", "pos", "path_rank", "path_score", F.concat(F.lit(HEAD), role, F.lit(COLON)).alias("head"),
        escape(F.col("text")).alias("body"), (F.col("role") == loss_role).alias("bears_loss"))
    size = F.length("head") + F.length("body") + len(END)
    before = Window.partitionBy("tree", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    span = F.struct(F.col("start").cast("int").alias("start"), F.length("body").alias("length"))
    rows = F.sort_array(F.collect_list(F.struct("pos", F.concat("head", "body", F.lit(END)).alias("turn"))))
    mask = F.sort_array(F.collect_list(F.when(F.col("bears_loss"), span)))
    return turns.groupBy("tree", "leaf").agg(
        F.first("conv_id").alias("conv_id"), F.first("path_rank").alias("path_rank"),
        F.first("path_score").alias("path_score"), F.array_join(rows["turn"], "").alias("formatted"),
        mask.alias("loss_mask"),
    ).drop("tree", "leaf")


def format_chats(nodes: DataFrame, best: int = 1, loss_role: str = "assistant") -> DataFrame:
    """The ``best`` paths of each reply tree as formatted conversations, see ``format_paths``."""
    paths, keyed = best_paths(nodes, best)
    return format_paths(paths, keyed, loss_role)


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with what a reader gets from ``formatted`` and ``loss_mask`` alone.

    ``turns``: list of (role, text); ``loss_text``: all text under the loss mask, unescaped.
    """
    parts = F.split("formatted", END, -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, COLON, 1)
        text = F.substr(part, F.length(role) + len(COLON) + 1)
        role = F.replace(F.substr(role, F.lit(len(HEAD) + 1)), F.lit("\\c"), F.lit(":"))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    under = F.transform("loss_mask", lambda span: F.substr(F.col("formatted"), span["start"] + 1, span["length"]))
    return chats.withColumns({
        "turns": F.transform(parts, turn), "loss_text": unescape(F.array_join(under, "")),
    })
