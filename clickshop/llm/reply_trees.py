"""Chat formatting of reply trees with built-in functions only.

Messages name their parents.  Self-joins that double the distance each round give every
message its path score up to the root; leaves are ranked by the score of their path, and
the same joins mark the messages of the chosen paths.  Each path becomes one conversation
in a template whose marks cannot occur in texts: a control string inside a text gets a
backslash after its first character, and one more if there are some already, so unescaping
gives back the text exactly.

    system     <<SYS>>text<</SYS>>
    user       [INST] text [/INST]
    assistant  <s>text</s>                        (the text is under the loss mask)
    others     <<ROLE>>role<</ROLE>>text</s>

Null roles and texts count as empty.  Null tree ids form one tree.  A message whose parent
is null or absent is a root.  Of rows that repeat a node id the least (by parent, role,
text, score) stays.  Messages that hang below a cycle of parents have no root and are left
out.  An empty table gives an empty result; extra columns are not read.  A conversation is
one row, so its text is held by one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickshop.llm.common import let, written

# The marks around a text by role.
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST] ", " [/INST]"),
    "assistant": ("<s>", "</s>"),
}
ROLE_MARKS = ("<<ROLE>>", "<</ROLE>>", "</s>")
LOSS_ROLE = "assistant"
_TAILS = r"(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|<ROLE>>|</ROLE>>)"
_TURN = (
    r"(?s)\[INST\] .*? \[/INST\]|<<SYS>>.*?<</SYS>>|<s>.*?</s>|<<ROLE>>.*?<</ROLE>>.*?</s>"
)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _TAILS, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _TAILS, "$1$2$3")


def _opening(role: Column) -> Column:
    """What stands before a turn's text."""
    other = F.concat(F.lit(ROLE_MARKS[0]), escape(role), F.lit(ROLE_MARKS[1]))
    return _by_role(role, {r: F.lit(a) for r, (a, _) in MARKS.items()}, other)


def _closing(role: Column) -> Column:
    return _by_role(role, {r: F.lit(b) for r, (_, b) in MARKS.items()}, F.lit(ROLE_MARKS[2]))


def _by_role(role: Column, values: dict[str, Column], other: Column) -> Column:
    return reduce(lambda c, r: c.when(role == r, values[r]), values, F).otherwise(other)


def paths(nodes: DataFrame, per_tree: int = 1) -> DataFrame:
    """``(tree, leaf, node, turn)`` of the best ``per_tree`` root-to-leaf paths.

    ``nodes`` has tree, node, parent and score, a row per node, and should be a written
    table.  The best path has the largest sum of scores, then the most messages, then the
    least leaf.
    """
    known = nodes.select("tree", F.col("node").alias("parent"))
    # A parent that is absent is none.
    rooted = nodes.join(known, ["tree", "parent"], "left_semi").select("tree", "node", "parent")
    start = nodes.select("tree", "node", F.coalesce("score", F.lit(0)).alias("gain")).join(
        rooted.withColumnRenamed("parent", "up"), ["tree", "node"], "left"
    )
    level = written(start.withColumn("depth", F.lit(1).cast("bigint")), "jumps")
    levels = []
    # Paths of n messages end within log2(n) rounds; what is open then hangs on a cycle.
    rounds = max(1, nodes.count()).bit_length()
    while len(levels) <= rounds and not level.filter("up is not null").isEmpty():
        levels.append(level)
        above = level.select(
            "tree",
            F.col("node").alias("up"),
            F.col("gain").alias("more"),
            F.col("depth").alias("deeper"),
            F.col("up").alias("next"),
        )
        moved = level.filter("up is not null").join(above, ["tree", "up"]).select(
            "tree",
            "node",
            (F.col("gain") + F.col("more")).alias("gain"),
            F.col("next").alias("up"),
            (F.col("depth") + F.col("deeper")).alias("depth"),
        )
        # Messages that reached their root are final and take no part in the join.
        done = level.filter("up is null").select("tree", "node", "gain", "up", "depth")
        level = written(done.union(moved), "jumps")
    parents = rooted.select("tree", F.col("parent").alias("node"))
    leaves = level.filter("up is null").join(parents, ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("gain"), F.desc("depth"), "node")
    marked = (
        leaves.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= per_tree)
        .select("tree", F.col("node").alias("leaf"), "node", F.col("depth").alias("turn"))
    )
    marked = written(marked, "paths")
    for k, jumps in enumerate(levels):  # ancestors 2**k to 2**(k + 1) - 1 steps up
        steps = jumps.filter("up is not null").select("tree", "node", "up")
        up = marked.join(steps, ["tree", "node"]).select(
            "tree", "leaf", F.col("up").alias("node"), (F.col("turn") - 2**k).alias("turn")
        )
        marked = written(marked.union(up), "paths")
    return marked


def format_trees(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """``(tree, leaf, n_turns, formatted, loss_mask)``, a row per chosen path.

    ``messages`` has tree, node, parent, role, text and score.  An entry of ``loss_mask``
    names a turn, where the text under the mask starts and ends within that turn, and
    where it starts in ``formatted``, in code points.
    """
    none = F.lit("\x00")
    rows = messages.select(
        F.coalesce(F.col("tree").cast("string"), none).alias("tree"),
        F.col("node").cast("bigint").alias("node"),
        F.struct(
            F.col("parent").cast("bigint").alias("parent"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.col("score").cast("double").alias("score"),
        ).alias("m"),
    )
    rows = written(rows.groupBy("tree", "node").agg(F.min("m").alias("m")), "messages")
    chosen = paths(rows.select("tree", "node", "m.parent", "m.score"), per_tree)
    role, text = F.col("m.role"), F.col("m.text")
    turns = chosen.join(rows, ["tree", "node"]).select(
        "tree",
        "leaf",
        "turn",
        (role == LOSS_ROLE).alias("loss"),
        F.length(_opening(role)).alias("open"),
        F.length(escape(text)).alias("chars"),
        F.concat(_opening(role), escape(text), _closing(role)).alias("part"),
    )
    before = Window.partitionBy("tree", "leaf").orderBy("turn").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = turns.withColumn(
        "begin", F.coalesce(F.sum(F.length("part").cast("bigint")).over(before), F.lit(0))
    )
    entry = F.struct(
        (F.col("turn") - 1).alias("turn"),
        F.col("open").alias("start"),
        (F.col("open") + F.col("chars")).alias("end"),
        (F.col("begin") + F.col("open")).alias("at"),
    )
    return (
        placed.groupBy("tree", "leaf")
        .agg(
            F.count("*").alias("n_turns"),
            F.sort_array(F.collect_list(F.struct("turn", "part"))).alias("parts"),
            F.sort_array(F.collect_list(F.when(F.col("loss"), entry))).alias("loss_mask"),
        )
        .select(
            F.when(F.col("tree") != none, F.col("tree")).alias("tree"),
            "leaf",
            "n_turns",
            F.array_join("parts.part", "").alias("formatted"),
            "loss_mask",
        )
    )


def turns_of(formatted: Column) -> Column:
    """The turns of a formatted conversation, each still in its marks."""
    return F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(0))


def read_turn(part: Column) -> Column:
    """Role and text of one turn, unescaped."""

    def inner(open_mark: str, close_mark: str, x: Column) -> Column:
        size = F.length(x) - len(open_mark) - len(close_mark)
        return F.substring(x, F.lit(len(open_mark) + 1), size)

    def struct(role: Column, text: Column) -> Column:
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    role = F.regexp_extract(part, r"(?s)^<<ROLE>>(.*?)<</ROLE>>", 1)
    text = F.regexp_extract(part, r"(?s)^<<ROLE>>.*?<</ROLE>>(.*)</s>$", 1)
    known = [
        F.when(part.startswith(a), struct(F.lit(r), inner(a, b, part)))
        for r, (a, b) in MARKS.items()
    ]
    return F.coalesce(*known, struct(role, text))


def loss_texts(formatted: Column, loss_mask: Column) -> Column:
    """The texts under the loss mask, unescaped, in order."""
    return let(
        turns_of(formatted),
        lambda parts: F.transform(
            loss_mask,
            lambda m: unescape(
                F.substring(
                    F.get(parts, m["turn"].cast("int")), m["start"] + 1, m["end"] - m["start"]
                )
            ),
        ),
    )
