"""Reply trees to conversations, with DataFrame operations only.

Messages form trees through their parent ids.  Pointer doubling (a self-join
per doubling, so log2 of the depth) gives every node its depth, its root and
the score summed along its path; leaves are ranked by that score and the best
``top_k`` per tree are chosen.  A chosen path is listed by walking the stored
jump tables from the largest power of two down: each ancestor is met exactly
once, so the work is the length of the chosen paths, never all pairs.

Each path is formatted as one string.  A turn is
``<s>[INST]`` role ``[/INST]`` text ``</s>``; inside role and text a backslash
goes after the opening bracket of every control string (one more where there
are some), which ``unescape`` takes away again, so nothing that a text says
can act as a mark.  ``loss_spans`` are (start, length) in code points of the
formatted string: the assistant texts.

Defined results: null text or role: empty; null tree id: a tree of its own
with a null id; a node whose parent is missing, or is itself: a root; rows
that repeat a (tree, node) key count once (smallest role and text stay); ties
between branches go to the smaller leaf id; an empty table gives no rows.
Nodes on a cycle reach no root and are left out.  Only the named columns are
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]))"
OPEN, MID, CLOSE = "<s>[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1$2$3")


def paths(nodes: DataFrame, top_k: int = 1) -> DataFrame:
    """Chosen paths as rows (tree, leaf, rank, score, depth, node).

    ``nodes`` has tree (a non-null string key), node, parent, score.
    """
    checkpoint_root(nodes.sparkSession)
    alive = nodes.select("tree", "node").withColumnsRenamed({"tree": "_pt", "node": "_pn"})
    moving = nodes.join(alive, (nodes.tree == alive._pt) & (nodes.parent == alive._pn) & (nodes.parent != nodes.node), "left") \
        .select("tree", "node", F.col("_pn").alias("up"),
                F.when(F.col("_pn").isNotNull(), 1).otherwise(0).cast("long").alias("steps"),
                F.coalesce("score", F.lit(0.0)).cast("double").alias("total")).checkpoint()
    limit = 2 * moving.count() + 2
    # nodes whose jump leaves the tree are done; only the others are joined on
    done = moving.where("up is null")
    moving = moving.where("up is not null")
    levels = [moving.select("tree", "node", "up")]
    while not moving.isEmpty() and 2 ** len(levels) <= limit:
        above = done.unionByName(moving).select(
            F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("up").alias("_up"),
            F.col("steps").alias("_steps"), F.col("total").alias("_total"))
        # the total of a node covers the nodes before ``up``; those from ``up`` on are added
        step = moving.join(above, (moving.tree == above._t) & (moving.up == above._n)).select(
            "tree", "node", F.col("_up").alias("up"), (F.col("steps") + F.col("_steps")).alias("steps"),
            (F.col("total") + F.col("_total")).alias("total")).checkpoint()
        done = done.unionByName(step.where("up is null"))
        moving = step.where("up is not null")
        levels.append(moving.select("tree", "node", "up"))
    inner = levels[0].select("tree", F.col("up").alias("node")).distinct()
    leaves = done.join(inner, ["tree", "node"], "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
    on_path = chosen.select("tree", F.col("node").alias("leaf"), "rank", F.col("total").alias("score"), "node",
                            F.col("steps").alias("depth"))
    for k in range(len(levels) - 1, -1, -1):
        up = levels[k].withColumnsRenamed({"tree": "_pt", "node": "_n"})
        here = F.struct(F.col("node").alias("node"), F.col("depth").alias("depth"))
        there = F.when(F.col("up").isNotNull(), F.struct(
            F.col("up").alias("node"), (F.col("depth") - 2 ** k).alias("depth")))
        on_path = on_path.join(up, (on_path.tree == up._pt) & (on_path.node == up._n), "left").select(
            "tree", "leaf", "rank", "score", F.explode(F.array_compact(F.array(here, there))).alias("_x")).select(
            "tree", "leaf", "rank", "score", "_x.node", "_x.depth")
    return on_path


def format_trees(messages: DataFrame, tree_col: str, node_col: str, parent_col: str, role_col: str = "role",
                 text_col: str = "text", score_col: str | None = None, top_k: int = 1,
                 loss_role: str = "assistant") -> DataFrame:
    """One row per chosen path: tree, leaf, rank, score, n_turns, formatted, loss_spans.

    Without ``score_col`` every message scores 1, so longer branches rank first.
    """
    score = F.col(score_col) if score_col else F.lit(1.0)
    raw = messages.select(
        F.col(tree_col).alias("tree_id"), F.col(node_col).alias("node"), F.col(parent_col).alias("parent"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        score.cast("double").alias("score"))
    # a string key keeps a null tree id joinable and apart from every other id
    keyed = raw.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col("tree_id").cast("string")), F.lit("null")))
    one = keyed.groupBy("tree", "node").agg(
        F.min(F.struct("role", "text", "parent", "score", "tree_id")).alias("_m")) \
        .select("tree", "node", "_m.*")
    path = paths(one.select("tree", "node", "parent", "score"), top_k)
    turn = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MID), escape(F.col("text")), F.lit(CLOSE))
    body = one.select("tree", "node", "tree_id", turn.alias("turn"),
                      F.char_length(escape(F.col("role"))).alias("role_len"), (F.col("role") == loss_role).alias("loss"))
    # a node may be on several chosen paths, so it joins by (tree, node); a path is one output value
    full = path.join(body, ["tree", "node"]).groupBy("tree", "leaf").agg(
        F.first("tree_id").alias("tree_id"), F.first("rank").alias("rank"), F.first("score").alias("score"),
        F.sort_array(F.collect_list(F.struct("depth", "turn", "role_len", "loss"))).alias("t"))
    head = len(OPEN) + len(MID)
    # running offsets: (position, spans so far) folded over the turns of the path
    spans = F.aggregate(
        F.col("t"), F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,len:int>>)").alias("s")),
        lambda acc, x: F.struct(
            (acc["at"] + F.char_length(x["turn"])).alias("at"),
            F.when(x["loss"], F.concat(acc["s"], F.array(F.struct(
                (acc["at"] + head + x["role_len"]).alias("start"),
                (F.char_length(x["turn"]) - head - len(CLOSE) - x["role_len"]).alias("len")))))
            .otherwise(acc["s"]).alias("s")),
        lambda acc: acc["s"])
    return full.select(
        "tree_id", "leaf", "rank", "score", F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["turn"]), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, read back: array of (role, text)."""
    closed = F.split(formatted, CLOSE)
    turns = F.slice(closed, 1, F.size(closed) - 1)

    def parts(t):
        inner = F.substr(t, F.lit(len(OPEN) + 1))
        role = F.substring_index(inner, MID, 1)
        text = F.substr(inner, F.char_length(role) + len(MID) + 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(turns, parts)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped span by span."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["len"]))), "")


def turn_parents(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Linear conversations as reply chains: ``node`` numbers the rows of a conversation by turn, ``parent`` is the one before."""
    one = rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                      F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return one.withColumn("node", F.row_number().over(order).cast("long")) \
        .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
