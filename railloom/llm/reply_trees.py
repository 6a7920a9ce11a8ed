"""Conversations from reply trees: paths from root to leaf by iterative self-joins, branches ranked by score.

Every message learns its root, its depth and the score of its whole path by pointer doubling: in round k a message
joins the message 2^k steps above it, so a path of length n takes log2(n) joins of narrow rows. The best leaves of a
tree are chosen by score, and walking the kept pointers back marks the messages of each chosen path. A path becomes
one text in which turns are marked, control strings inside texts are escaped reversibly, and a mask names the parts
that count for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railloom.operators.staging import stage

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
#: Strings that chat templates use for control; they end in > or ], so no two of them overlap.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
LEARNED_ROLE = "assistant"


#: The first character of a control string and the rest of it.
CONTROL_PATTERN = r"(<|\[)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>)"


def escape(text: Column) -> Column:
    """Backslashes are doubled and one is put behind the first character of every control string."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL_PATTERN, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def escape_role(role: Column) -> Column:
    """As a text, and without line feeds, which end the role."""
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def thread(df: DataFrame, tree: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Reply trees of plain conversations: every turn answers the one before it.

    Turns with equal (or null) positions are ordered by role and text, nulls first, and all stay.
    """
    rows = df.select(
        F.col(f"`{tree}`").cast("long").alias("tree_id"), F.col(f"`{order}`").alias("place"), F.col(f"`{role}`").alias("role"), F.col(f"`{text}`").alias("text")
    )
    number = F.row_number().over(Window.partitionBy("tree_id").orderBy("place", "role", "text")).cast("long")
    numbered = rows.select("tree_id", number.alias("message_id"), "role", "text")
    parent = F.when(F.col("message_id") > 1, F.col("message_id") - 1)
    return numbered.select("tree_id", "message_id", parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """Messages on the chosen paths: tree_id, branch (1 is best), message_id, depth (root 1).

    A branch ranks by the sum of scores on its path (null scores count 0), ties by the smaller leaf id. A message
    whose parent is missing or null is a root; a tree with several roots has the branches of all. A message that
    answers itself, directly or around a circle, has no root and is on no path. Of repeated rows one counts.
    """
    nodes = messages.select(
        F.coalesce(F.col("tree_id"), F.lit(-(2**63))).alias("tree_id"), "message_id", "parent_id", F.coalesce(F.col("score"), F.lit(0.0)).alias("score")
    ).where("message_id IS NOT NULL")
    nodes = stage(nodes.groupBy("tree_id", "message_id").agg(F.min("parent_id").alias("parent_id"), F.max("score").alias("score")), "reply-nodes")
    known = nodes.select("tree_id", F.col("message_id").alias("parent_id"), F.lit(True).alias("known"))
    linked = nodes.join(known, ["tree_id", "parent_id"], "left")
    up = linked.select(
        "tree_id", "message_id", F.when(F.col("known"), F.col("parent_id")).alias("above"), F.lit(1).cast("long").alias("depth"), F.col("score").alias("total")
    )
    up = stage(up, "reply-up")
    # only messages that have not reached their root go on; each round doubles how far the others are
    rooted, going, most = up.where("above IS NULL"), up.where("above IS NOT NULL"), nodes.count()
    levels = [going]
    while True:
        open_, deepest = going.agg(F.count(F.lit(1)), F.max("depth")).head()
        # a path cannot be longer than the number of messages; what is still open then goes around a circle
        if not open_ or deepest > most:
            break
        higher = rooted.union(going).select(
            "tree_id", F.col("message_id").alias("above"), F.col("above").alias("_above"), F.col("depth").alias("_depth"), F.col("total").alias("_total")
        )
        joined = going.join(higher, ["tree_id", "above"]).select(
            "tree_id", "message_id", F.col("_above").alias("above"), (F.col("depth") + F.col("_depth")).alias("depth"), (F.col("total") + F.col("_total")).alias("total")
        )
        up = stage(joined, "reply-up")
        rooted, going = rooted.union(up.where("above IS NULL")), up.where("above IS NOT NULL")
        levels.append(going)
    parents = levels[0].select("tree_id", F.col("above").alias("message_id")).distinct()
    leaves = rooted.join(parents, ["tree_id", "message_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree_id").orderBy(F.col("total").desc(), "message_id"))
    marked = leaves.withColumn("branch", rank).where(F.col("branch") <= per_tree).select("tree_id", "branch", "message_id")
    for level in reversed(levels):
        higher = marked.join(level, ["tree_id", "message_id"]).select("tree_id", "branch", F.col("above").alias("message_id"))
        marked = stage(marked.union(higher).distinct(), "reply-paths")
    return marked.join(rooted.select("tree_id", "message_id", "depth"), ["tree_id", "message_id"])


def format_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """One row per chosen path: tree_id, branch, formatted, mask.

    ``messages`` has tree_id, message_id, parent_id, role, text and score; more columns are ignored. Null text is
    empty text, null role an empty role. ``mask`` is an array of (turn, start, length) in code points: the part of
    turn number ``turn`` (from 0) that counts for the loss, which is the text of every assistant turn. A conversation
    is one string, so its turns meet in one row; nothing larger does.
    """
    first = F.row_number().over(Window.partitionBy("tree_id", "message_id").orderBy("role", "text"))
    texts = messages.select(F.coalesce(F.col("tree_id"), F.lit(-(2**63))).alias("tree_id"), "message_id", "role", "text").withColumn("_n", first).where("_n = 1")
    turns = paths(messages, per_tree).join(texts, ["tree_id", "message_id"])
    head = F.concat(F.lit(BEGIN), escape_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    body = escape(F.col("text"))
    piece = F.struct(
        F.col("depth"),
        head.alias("head"),
        body.alias("body"),
        F.coalesce(F.col("role") == LEARNED_ROLE, F.lit(False)).alias("learned"),
    )
    grouped = turns.select("tree_id", "branch", piece.alias("piece")).groupBy("tree_id", "branch").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    whole = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "")
    spans = F.transform(
        F.filter(F.transform("pieces", lambda p, i: F.struct(i.alias("turn"), p.alias("p"))), lambda x: x["p"]["learned"]),
        lambda x: F.struct(x["turn"].alias("turn"), F.char_length(x["p"]["head"]).alias("start"), F.char_length(x["p"]["body"]).alias("length")),
    )
    tree = F.when(F.col("tree_id") != F.lit(-(2**63)), F.col("tree_id"))
    return grouped.select(tree.alias("tree_id"), "branch", whole.alias("formatted"), spans.alias("mask"))


def turns_of(formatted: Column) -> Column:
    """The turns as they stand in the output, from the marking of the turn to the end of its text, still escaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def read_turns(formatted: Column) -> Column:
    """(role, text) of every turn, read back from the output."""

    def turn(piece: Column) -> Column:
        line_end = F.instr(piece, "\n")
        role = F.substr(piece, F.lit(len(BEGIN) + 1), line_end - F.lit(len(BEGIN) + 1))
        return F.struct(unescape_role(role).alias("role"), unescape(F.substr(piece, line_end + 1)).alias("text"))

    return F.transform(turns_of(formatted), turn)


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The texts under the loss mask in order, unescaped, read back from the output."""
    pieces = turns_of(formatted)
    return F.transform(mask, lambda m: unescape(F.substr(F.element_at(pieces, m["turn"] + 1), m["start"] + 1, m["length"])))
