"""Chat formatting of reply trees, in DataFrame functions only.

Messages form trees by their parents. A path from a root to a leaf is one
conversation; the best ones of each tree are formatted.

- *Jumps.* Round k joins the table of jumps with itself: a jump of 2^k replies
  followed by another makes one of 2^(k+1). After as many rounds as the deepest path
  has binary digits, each message knows its root, its depth and the sum of the scores
  on the way. The tables hold no texts and are written to the shared folder.
- *Ranking.* The leaves of a tree are ranked by the sum of the scores on their path,
  then by id, and the first `best` are kept; `best=None` keeps every one.
- *Paths.* A chosen path is listed from its leaf through the same tables: each round
  adds, for each message found so far, the one 2^k replies before it. A path of any
  length needs as many joins as its length has digits. All joins are on the ids of
  messages, so a tree that holds a third of them is many keys.
- *Formatting.* Texts are joined to the paths they are on, and each path is put
  together in one row. Only this gathers a conversation, since it is the result: one
  has to fit into a row (2 GB).

A turn is `<|turn|>` role `<|text|>` text `<|end|>`. Inside roles and texts each
backslash is doubled, and each control string (these marks, and those of common chat
models) gets a backslash after its first character, so that no text can pass for a
mark; `unescaped` undoes both. The loss mask says of each piece of the formatted text,
as `pieces` cuts it, whether it is to be learned: the texts of `learned` roles.

Null roles and texts count as empty, null and NaN scores as 0. A message whose parent is
null, itself or not in the table is a root. Messages that reply to one another in a ring
have no root, so they and the replies to them are on no path. Rows without an id are left
out (`in_turns` gives every row one). Rows that share an id are turns in the same place,
ordered by role and text, with the smallest of their parents and the highest of their
scores. Further columns are ignored. An empty table gives no rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.storage import materialise

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: What may not stand in a text: how the template's own marks begin, and the marks of common models. Fixed values.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LEARNED = ("assistant",)


def escaped(text: Column) -> Column:
    """The text without control strings."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    """What `escaped` was given: of each backslash and the character after it, the character."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def pieces(formatted: Column) -> Column:
    """The formatted text cut at its marks: for each turn an empty piece, role and text; then an empty one."""
    return F.split(formatted, r"<\|(?:turn|text|end)\|>", -1)


def turns(formatted: Column) -> Column:
    """The turns read back, as an array of (role, text)."""
    cut = pieces(formatted)
    roles, texts = F.filter(cut, lambda _, i: i % 3 == 1), F.filter(cut, lambda _, i: (i > 0) & (i % 3 == 2))
    return F.transform(F.arrays_zip(roles.alias("role"), texts.alias("text")), lambda t: F.struct(
        unescaped(t["role"]).alias("role"), unescaped(t["text"]).alias("text")))


def under_mask(formatted: Column, mask: Column) -> Column:
    """All text whose pieces the loss mask marks, unescaped, with nothing between."""
    marked = F.filter(F.arrays_zip(pieces(formatted).alias("piece"), mask.alias("learned")), lambda p: p["learned"])
    return F.array_join(F.transform(marked, lambda p: unescaped(p["piece"])), "")


def in_turns(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> tuple[DataFrame, DataFrame]:
    """The replies and the texts of a table without branches: each turn replies to the one before it.

    A row's id is its conversation and turn; null turns come first, a null conversation is one.
    """
    own = F.struct(conversation, turn)
    before = F.lag(own).over(Window.partitionBy(conversation).orderBy(turn))
    replies = rows.select(conversation, turn).distinct().select(
        own.alias("message_id"), before.alias("parent_id"), F.lit(0.0).alias("score"))
    return replies, rows.select(own.alias("message_id"), "role", "text")


def format_trees(messages: DataFrame, best: int | None = 1, learned: Sequence[str] = LEARNED) -> DataFrame:
    """The best conversations of each tree of messages (message_id, parent_id, role, text, score).

    Returns tree (id of the root), path (id of the leaf), rank and score in the tree, n_messages
    (turns), formatted, loss_mask (array of boolean).
    """
    return format_paths(reply_paths(messages, best), messages, learned)


def reply_paths(replies: DataFrame, best: int | None = 1) -> DataFrame:
    """The chosen paths of each tree, a row for each message on them: tree, path, rank, score, place
    (replies from the root), message_id."""
    score = F.coalesce(F.nanvl(F.col("score").cast("double"), F.lit(0.0)), F.lit(0.0))
    nodes = materialise(
        replies.where(F.col("message_id").isNotNull()).groupBy(F.col("message_id").alias("id"))
        .agg(F.min("parent_id").alias("parent"), F.max(score).alias("score")), "messages")
    tables, top = _jumps(nodes)
    parents = nodes.select(F.col("parent").alias("id"), (F.col("parent") == F.col("id")).alias("own"))\
        .where("id IS NOT NULL AND NOT own").select("id")
    leaves = top.join(parents, "id", "left_anti")
    in_tree = Window.partitionBy("at").orderBy(F.desc("total"), "id")
    chosen = leaves.withColumn("total", F.col("way") + F.col("at_score")).withColumn("rank", F.row_number().over(in_tree))
    if best is not None:
        chosen = chosen.where(F.col("rank") <= best)
    path = F.struct(F.col("at").alias("tree"), F.col("id").alias("path"), "rank", F.col("total").alias("score"))
    found = chosen.select(path.alias("p"), "id", F.col("hops").alias("place"))
    for k, jumps in reversed(list(enumerate(tables))):
        full = jumps.where(F.col("hops") == 1 << k).select("id", "at")
        step = F.struct(F.col("at").alias("id"), (F.col("place") - (1 << k)).alias("place"))
        both = F.array(F.struct("id", "place"), step)
        found = found.join(full, "id", "left").select(
            "p", F.inline(F.when(F.col("at").isNull(), F.slice(both, 1, 1)).otherwise(both)))
    return found.select("p.tree", "p.path", "p.rank", "p.score", "place", F.col("id").alias("message_id"))


def _jumps(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tables of jumps, and the one that leads each message to its root.

    Table k: id; at, the message 2^k replies before it, or its root if that is nearer; hops, the
    replies between; way, the scores on the way but that of `at`; at_score.
    """
    up = nodes.select(F.col("id").alias("parent"), F.col("score").alias("parent_score"))
    is_reply = F.col("parent_score").isNotNull() & (F.col("parent") != F.col("id"))
    first = nodes.join(up, "parent", "left").select(
        "id", F.when(is_reply, F.col("parent")).otherwise(F.col("id")).alias("at"),
        F.when(is_reply, 1).otherwise(0).cast("long").alias("hops"),
        F.when(is_reply, F.col("score")).otherwise(0.0).alias("way"),
        F.when(is_reply, F.col("parent_score")).otherwise(F.col("score")).alias("at_score"))
    table = materialise(first, "jumps")
    tables, count = [], table.count()
    # a path has fewer replies than there are messages: what jumps further is in a ring
    while (1 << len(tables)) < count and not table.where(F.col("hops") == 1 << len(tables)).isEmpty():
        tables.append(table)
        full = F.col("hops") == 1 << (len(tables) - 1)
        then = table.select(F.col("id").alias("at"), F.col("at").alias("next"), F.col("hops").alias("more"),
                            F.col("way").alias("further"), F.col("at_score").alias("next_score"))
        joined = table.where(full).join(then, "at").select(
            "id", F.col("next").alias("at"), (F.col("hops") + F.col("more")).alias("hops"),
            (F.col("way") + F.col("further")).alias("way"), F.col("next_score").alias("at_score"))
        table = materialise(table.where(~full).select(joined.columns).union(joined), "jumps")
    return tables, table.where(F.col("hops") < 1 << len(tables))


def format_paths(paths: DataFrame, texts: DataFrame, learned: Sequence[str] = LEARNED) -> DataFrame:
    """Each path as one formatted conversation, with the loss mask of its pieces."""
    empty = F.lit("")
    turn = F.struct("place", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    gathered = paths.join(texts.select("message_id", "role", "text"), "message_id")\
        .groupBy("tree", "path", "rank", "score").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    formatted = F.transform("t", lambda t: F.concat(
        F.lit(TURN), escaped(t["role"]), F.lit(TEXT), escaped(t["text"]), F.lit(END)))
    masks = F.flatten(F.transform("t", lambda t: F.array(F.lit(False), F.lit(False), t["role"].isin(*learned))))
    return gathered.select("tree", "path", "rank", "score", F.size("t").cast("long").alias("n_messages"),
                           F.array_join(formatted, "").alias("formatted"),
                           F.concat(masks, F.array(F.lit(False))).alias("loss_mask"))
