"""Reply trees formatted as conversations, with DataFrame operations only.

Messages are nodes with a parent. Iterative self-joins double the distance of ancestor pointers, then add to each leaf's
path the ancestors at these distances, so that paths of any depth need a logarithmic number of joins and rows in
proportion to the paths. Branches rank by the sum of their scores (ties: smaller leaf); only the chosen paths meet their
texts and are formatted.

Template: a turn is ``### role: text</turn>`` and a line break. In texts a backslash becomes ``\\b``, ``###`` ``\\h`` and
``</turn>`` ``\\t``; in roles a colon also becomes ``\\c`` and a line break ``\\n``. Every backslash of the result has its letter
behind it, so replacing the letters back, ``\\b`` last, restores the text.

Null texts and roles are empty; a null conversation id is a conversation of its own; turns with equal numbers follow in
order of role and text; repeated rows are turns of their own. Extra columns are ignored; an empty table has no paths.
A conversation is one row of output, so it must fit a task; its length bounds what one task holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table, written
from .pii import bind, pair, running

HEAD, END = "### ", "</turn>\n"


def escape(x: Column) -> Column:
    x = F.replace(F.coalesce(x, F.lit("")), F.lit("\\"), F.lit("\\b"))
    return F.replace(F.replace(x, F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\t"))


def unescape(x: Column) -> Column:
    x = F.replace(F.replace(x, F.lit("\\h"), F.lit("###")), F.lit("\\t"), F.lit("</turn>"))
    return F.replace(x, F.lit("\\b"), F.lit("\\"))


def escape_role(x: Column) -> Column:
    return F.replace(F.replace(escape(x), F.lit(":"), F.lit("\\c")), F.lit("\n"), F.lit("\\n"))


def unescape_role(x: Column) -> Column:
    return unescape(F.replace(F.replace(x, F.lit("\\c"), F.lit(":")), F.lit("\\n"), F.lit("\n")))


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Conversations by turn as trees of one path: conv_id, node, parent, score, role, text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return rows.select("conv_id", node.cast("long").alias("node"), F.when(node > 1, (node - 1).cast("long")).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def leaf_paths(nodes: DataFrame, depth: int) -> DataFrame:
    """conv_id, leaf, node, level (0: the leaf) of every root-to-leaf path of at most ``depth`` nodes.

    nodes: conv_id, node, parent. Pointers over 1, 2, 4, ... steps come from joining the pointers with themselves.
    """
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id"))
    jumps = [nodes.where(F.col("parent").isNotNull()).select("conv_id", "node", F.col("parent").alias("up"))]
    while 2 ** len(jumps) < depth:
        last = jumps[-1]
        jumps.append(written(last.alias("a").join(last.alias("b"), same & (F.col("a.up") == F.col("b.node"))).select("a.conv_id", "a.node", F.col("b.up").alias("up")), "jumps"))
    leaves = nodes.alias("a").join(nodes.where(F.col("parent").isNotNull()).alias("b"), same & (F.col("a.node") == F.col("b.parent")), "left_anti")
    paths = leaves.select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("level"))
    for k in range(len(jumps) - 1, -1, -1):
        up = paths.alias("a").join(jumps[k].alias("b"), same & (F.col("a.node") == F.col("b.node"))).select("a.conv_id", "a.leaf", F.col("b.up").alias("node"), (F.col("a.level") + 2**k).alias("level"))
        paths = written(paths.unionByName(up), "paths")  # read twice in the next round
    return paths


def format_trees(nodes: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, leaf, branch (1: highest score), formatted, loss (start and end of each assistant text, in code points).

    nodes: conv_id, node, parent (null: root), score, role, text; node is unique within conv_id.
    """
    nodes = written(nodes.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"), "role", "text"), "nodes")
    depth = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1
    paths = leaf_paths(nodes, depth)
    on = lambda *names: [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in names]
    scored = paths.alias("a").join(nodes.alias("b"), on("conv_id", "node")).groupBy("a.conv_id", "a.leaf").agg(F.sum("b.score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.desc("score"), "leaf"))
    chosen = scored.withColumn("branch", rank).where(F.col("branch") <= best)
    own = paths.alias("a").join(chosen.alias("b"), on("conv_id", "leaf")).select("a.conv_id", "a.leaf", "a.node", "a.level", "b.branch", "b.score")
    own = own.alias("a").join(nodes.alias("b"), on("conv_id", "node")).select("a.conv_id", "a.leaf", "a.level", "a.branch", "a.score", "b.role", "b.text")
    turns = F.sort_array(F.collect_list(F.struct((-F.col("level")).alias("at"), escape_role(F.col("role")).alias("role"), escape(F.col("text")).alias("text"))))
    whole = own.groupBy("conv_id", "leaf", "branch", "score").agg(turns.alias("turns"))
    head = lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(": "))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(END))), "")
    sizes = F.transform("turns", lambda t: pair(F.length(head(t)) + F.length(t["text"]) + len(END), F.lit(0)))
    begun = bind(sizes, lambda x: running(x, pair(F.lit(0), F.lit(0)), lambda s, y: pair(s["a"] + y["a"], F.lit(0))))
    spans = F.zip_with("turns", begun, lambda t, at: F.struct((at["a"] + F.length(head(t))).alias("start"), (at["a"] + F.length(head(t)) + F.length(t["text"])).alias("end"), (t["role"] == "assistant").alias("own")))
    loss = F.transform(F.filter(spans, lambda x: x["own"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    return written(whole.select("conv_id", "leaf", "branch", "score", formatted.alias("formatted"), loss.alias("loss")), "formatted")


def read_formatted(df: DataFrame) -> DataFrame:
    """What stands in formatted conversations: turns, unescaped, and the text under the loss mask."""
    parts = F.split("formatted", "</turn>\\n", -1)
    turns = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.struct(unescape_role(F.substring_index(F.substr(p, F.lit(len(HEAD) + 1)), ":", 1)).alias("role"), unescape(F.substr(p, F.instr(p, ": ") + 2)).alias("text")))
    loss = F.array_join(F.transform("loss", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["end"] - s["start"]))), "")
    return df.select("*", turns.alias("turns"), loss.alias("loss_text"))


def read_back(df: DataFrame) -> DataFrame:
    own = read_formatted(df.select("conv_id", "formatted", "loss"))
    each = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return own.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(each, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


EXTRA_TEXT = "\\### Assistant: </turn> ok"


def op5_reply_trees(spark, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TEXT).alias("text"))
    return read_back(format_trees(linear_nodes(own.unionByName(extra))))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') AS et, replace(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c'), chr(10), '\n') AS er FROM c),
s AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length('### ' || er || ': ' || et || '</turn>' || chr(10)))::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM s
"""
