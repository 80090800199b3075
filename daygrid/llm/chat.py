r"""Chat formatting: reply trees to conversations, by DataFrame operations alone.

Messages form trees by ``parent``. Every node learns its depth and the score of its path by pointer
doubling: a self-join in which each node takes over the pointer of the ancestor that it
points to, so a chain of n messages needs log2(n) joins. The leaves are ranked inside their tree, and the
paths of the chosen ones are unrolled with the same pointers, halving their length in
each self-join. Only then are role and text joined and each path made one string.

Template: ``### role: text</turn>`` and a line feed for each turn. Inside texts and roles
``\`` becomes ``\e``, ``</turn>`` ``\t``, ``###`` ``\h``, and in roles ``:`` becomes ``\c``, so
the marks of the template never occur inside; undoing it backwards gives the text again.

Defined cases: NULL role or text is empty; a NULL tree is a tree of its own; a parent that does not exist
makes its child a root; nodes that hang on a cycle have no root and are on no path; a node
that is given more than once counts once, with its least (parent, role, text, score); NULL scores
count 0; ties between leaves go to the smaller node; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daygrid.sizing import stored

HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
ASSISTANT = "assistant"
# Control strings and what stands for them.
MARKS = [("\\", "\\e"), ("</turn>", "\\t"), ("###", "\\h")]
ROLE_MARKS = [*MARKS, (":", "\\c")]


def escaped(text: Column, marks: list[tuple[str, str]] = MARKS) -> Column:
    for plain, mark in marks:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column, marks: list[tuple[str, str]] = MARKS) -> Column:
    for plain, mark in reversed(marks):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _same(left: str, right: str, node: str, other: str = "node") -> Column:
    return F.col(f"{left}.tree").eqNullSafe(F.col(f"{right}.tree")) & (F.col(f"{left}.{node}") == F.col(f"{right}.{other}"))


def pointers(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth and total score of the path of each node, and for each k the ancestor 2**k steps up (where there is one)."""
    known = nodes.alias("n").join(nodes.alias("p"), _same("n", "p", "parent"), "left")
    state = stored(known.select("n.tree", "n.node", F.col("p.node").alias("jump"), F.lit(1).alias("depth"), F.coalesce("n.score", F.lit(0.0)).alias("total")))
    n, jumps = state.count(), []
    # Nodes whose pointer has passed the root are done; only the others take part in the next join.
    done, active = [state.where("jump IS NULL")], state.where("jump IS NOT NULL")
    while 2 ** len(jumps) <= n and not active.isEmpty():
        jumps.append(active.select("tree", "node", "jump"))
        joined = active.alias("n").join(reduce(DataFrame.union, [*done, active]).alias("p"), _same("n", "p", "jump"))
        state = stored(joined.select("n.tree", "n.node", "p.jump", (F.col("n.depth") + F.col("p.depth")).alias("depth"), (F.col("n.total") + F.col("p.total")).alias("total")), small=True)
        done.append(state.where("jump IS NULL"))
        active = state.where("jump IS NOT NULL")
    return reduce(DataFrame.union, done).drop("jump"), jumps


def best_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """The nodes on the ``keep`` best root-to-leaf paths of each tree: ``tree, path, score, node, position`` from 1.

    A path is named by its leaf; its score is the mean over its messages.
    """
    nodes = stored(nodes.groupBy("tree", "node").agg(F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("x")).select("tree", "node", "x.*"))
    depths, jumps = pointers(nodes)
    leaves = depths.alias("n").join(nodes.alias("c"), _same("n", "c", "node", "parent"), "left_anti")
    score = F.col("total") / F.col("depth")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(score.desc(), "node"))
    spans = leaves.withColumn("rank", rank).where(F.col("rank") <= keep).select("tree", F.col("node").alias("path"), score.alias("score"), "node", F.col("depth").alias("position"), F.col("depth").alias("length"))
    for k in reversed(range(len(jumps))):
        half, spans = 2**k, stored(spans, small=True)  # it is read twice
        upper = spans.where(F.col("length") > half).alias("s").join(jumps[k].alias("j"), _same("s", "j", "node"))
        spans = spans.withColumn("length", F.least("length", F.lit(half))).unionByName(
            upper.select("s.tree", "s.path", "s.score", F.col("j.jump").alias("node"), (F.col("s.position") - half).alias("position"), (F.col("s.length") - half).alias("length"))
        )
    return spans.drop("length")


def formatted(messages: DataFrame, keep: int = 1) -> DataFrame:
    """One row per chosen path: ``tree, path, score, n_turns, formatted, mask``.

    ``messages``: ``tree, node, parent, role, text, score``. ``mask`` has an entry for each
    turn: where the turn starts, and for an assistant's turn where its text starts and its length, in code points.
    """
    messages = messages.select("tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score")
    once = messages.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("x")).select("tree", "node", "x.*")
    turns = best_paths(once.select("tree", "node", "parent", "score"), keep).alias("p").join(once.alias("m"), _same("p", "m", "node"))
    head = F.concat(F.lit(HEAD), escaped(F.col("m.role"), ROLE_MARKS), F.lit(MIDDLE))
    turns = turns.select("p.*", "m.role", head.alias("head"), escaped(F.col("m.text")).alias("body"))
    length = F.char_length("head") + F.char_length("body") + len(END)
    before = Window.partitionBy("tree", "path").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.sum(length.cast("bigint")).over(before) - length
    trained = F.col("role") == ASSISTANT
    mask = F.struct(
        F.col("at").alias("turn_start"),
        F.when(trained, F.col("at") + F.char_length("head")).alias("start"),
        F.when(trained, F.char_length("body")).alias("length"),
    )
    turn = F.struct("position", F.concat("head", "body", F.lit(END)).alias("turn"), mask.alias("mask"))
    return turns.withColumn("at", at).groupBy("tree", "path").agg(F.first("score").alias("score"), F.sort_array(F.collect_list(turn)).alias("turns")).select(
        "tree", "path", "score", F.size("turns").cast("bigint").alias("n_turns"), F.array_join("turns.turn", "").alias("formatted"), F.col("turns.mask").alias("mask")
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """``conversations`` with ``turns`` (role and text) and ``loss_text`` (all that is under the mask), from the formatted string."""
    parts = F.split("formatted", END)
    parts = F.slice(parts, 1, F.size(parts) - 1)
    role = lambda part: unescaped(F.substring_index(F.substring(part, len(HEAD) + 1, 2**31 - 1), MIDDLE, 1), ROLE_MARKS)
    head = lambda part: F.char_length(F.substring_index(part, MIDDLE, 1)) + len(MIDDLE)
    turns = F.transform("parts", lambda part: F.struct(role(part).alias("role"), unescaped(F.substr(part, head(part) + 1)).alias("text")))
    under = F.zip_with("parts", "mask", lambda part, m: F.substr(part, (m["start"] - m["turn_start"] + 1).cast("int"), m["length"]))
    loss = F.array_join(F.transform(F.filter(under, lambda text: text.isNotNull()), lambda text: unescaped(text)), "")
    return conversations.withColumn("parts", parts).withColumns({"turns": turns, "loss_text": loss}).drop("parts")


def linear_trees(rows: DataFrame) -> DataFrame:
    """Messages of the trees that have one branch each: ``conv_id, turn, role, text`` in the order of turns (ties by role, then text)."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = rows.select(F.col("conv_id").alias("tree"), place.alias("node"), "role", "text")
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))
