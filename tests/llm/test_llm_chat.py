"""Reply trees against plain walks, and the template read back."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meterflow.llm import chat

MESSAGE = "message_id long, parent_id long, role string, text string, score double"


def plain_escape(text):
    text = text.replace("\\", "\\\\")
    for c in chat.CONTROL:
        text = text.replace(c, f"{c[0]}\\{c[1:]}")
    return text


def plain(rows, best, learned=chat.LEARNED):
    """{(tree, path): (rank, score, turns)} by walking up from every leaf."""
    at = defaultdict(list)
    for i, p, role, text, score in rows:
        if i is not None:
            at[i].append((p, 0.0 if score is None or score != score else score, role or "", text or ""))
    up = {}
    for i, g in at.items():
        p = min((x[0] for x in g if x[0] is not None), default=None)
        up[i] = p if p in at and p != i else None
    score = {i: max(x[1] for x in g) for i, g in at.items()}
    trees = defaultdict(list)
    for leaf in set(at) - {p for p in up.values() if p is not None}:
        path, i = [], leaf
        while i is not None and len(path) <= len(at):
            path.append(i)
            i = up[i]
        if i is None:
            trees[path[-1]].append((-sum(score[i] for i in path), leaf, path[::-1]))
    out = {}
    for root, paths in trees.items():
        for rank, (total, leaf, path) in enumerate(sorted(paths), 1):
            if best is None or rank <= best:
                turns = [(r, t) for i in path for _, _, r, t in sorted(at[i], key=lambda x: (x[2].encode(), x[3].encode()))]
                out[root, leaf] = (rank, -total, turns)
    return out


def check(spark, rows, best, learned=chat.LEARNED):
    made = chat.format_trees(spark.createDataFrame(rows, MESSAGE), best, learned).select(
        "*", chat.turns(F.col("formatted")).alias("t"), chat.under_mask(F.col("formatted"), F.col("loss_mask")).alias("loss"),
        F.size(chat.pieces(F.col("formatted"))).alias("n_pieces"))
    got = made.collect()
    want = plain(rows, best, learned)
    assert {(r.tree, r.path) for r in got} == set(want) and len(got) == len(want)
    for r in got:
        rank, score, turns = want[r.tree, r.path]
        assert (r["rank"], r.n_messages) == (rank, len(turns)) and r["score"] == pytest.approx(score)
        assert r.formatted == "".join(
            f"{chat.TURN}{plain_escape(a)}{chat.TEXT}{plain_escape(b)}{chat.END}" for a, b in turns)
        assert [tuple(x) for x in r.t] == turns
        assert r.loss == "".join(t for role, t in turns if role in learned)
        assert len(r.loss_mask) == r.n_pieces
    return got


TRICKY = ["", "\\", "\\\\", "<|", "<\\|", "<", "|", "|>", "<|end|>", "<|text|>x<|turn|>", "</s>[INST] ok [/INST]", "<s", "s>", "<<SYS>>",
          "<<s>", "a\nb\\\n", "[INST", "\\<|end|>\\", "é 日本 😀 \x00", "$1 \\$1", "<\\/s>"]


def test_trees_with_ties_orphans_rings_and_repeated_ids(spark):
    rows = [(1, None, "user", "root", 1.0), (2, 1, "assistant", "a", 0.5), (3, 1, "assistant", "b", 0.5), (4, 2, "user", "c", 0.0),
            (5, 99, "user", "orphan", 1.0), (6, 5, None, None, None), (7, 7, "user", "own", float("nan")),
            (8, 9, "user", "ring", 1.0), (9, 8, "user", "ring", 1.0), (10, 9, "user", "hangs on a ring", 1.0),
            (None, 1, "user", "no id", 1.0), (11, 1, "user", "twice", 0.1), (11, 1, "user", "twice", 0.1), (11, 3, "system", "same id", 0.2),
            (12, 11, "assistant", "x" * 200_000, 9.0)]
    for best in (1, 2, None):
        check(spark, rows, best)
    check(spark, rows, None, ("user", "system"))


def test_control_strings_come_back(spark):
    rows = [(i, i - 1 if i % 3 else None, r, t, 1.0) for i, (r, t) in enumerate(
        (r, t) for r in ("user", "assistant", "<|end|>\\") for t in TRICKY)]
    got = check(spark, rows, 1)
    marks = {chat.TURN, chat.TEXT, chat.END}
    for r in got:
        left = r.formatted
        for m in marks:
            left = left.replace(m, "\x01")
        assert not any(c in left for c in chat.CONTROL)


@pytest.mark.parametrize("seed", range(3))
def test_random_trees(spark, seed):
    pick = random.Random(seed)
    rows = [(i, pick.choice([None, i - 1, i - 1, pick.randrange(0, 200)]), pick.choice(["user", "assistant"]), f"t{i}",
             pick.choice([0.0, 1.0, -1.0, 0.25])) for i in range(200)]
    check(spark, rows, pick.choice([1, 3, None]))


def test_a_long_chain(spark):
    got = check(spark, [(i, i - 1, "user" if i % 2 else "assistant", f"t{i}", 1.0) for i in range(1000)], 1)
    assert got[0].n_messages == 1000


def test_empty_table_and_turns(spark):
    assert chat.format_trees(spark.createDataFrame([], MESSAGE)).count() == 0
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 5, "assistant", None), (1, None, None, "first"), (None, 1, "user", "n"),
            (None, 2, "assistant", "m"), (2, 3, "assistant", "only")]
    replies, texts = chat.in_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    made = chat.format_paths(chat.reply_paths(replies), texts.withColumn("rank", F.lit("kept out")))
    got = {r.path.conv_id: [tuple(t) for t in r.t] for r in made.select("path", chat.turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("", "first"), ("user", "a"), ("user", "a"), ("assistant", "")], None: [("user", "n"), ("assistant", "m")],
                   2: [("assistant", "only")]}


def test_no_python_in_the_plan(spark, sf):
    from meterflow.llm.queries import QUERIES
    plan = QUERIES["op12_chat_format"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
