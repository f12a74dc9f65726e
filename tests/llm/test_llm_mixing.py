"""Mixing against a plain recursive version."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cases import edge_docs, empty_docs, words
from meterflow.llm import mixing as m


def divided(budget, nodes):
    """{name: tokens} of a budget for {name: (most, weight)}; whole numbers, what can't be used goes to the others."""
    out = {}
    order = sorted((n for n in nodes if nodes[n][1] > 0), key=lambda n: (nodes[n][0] / nodes[n][1], n))
    while order:
        most, weight = nodes[order[0]]
        total = sum(nodes[n][1] for n in order)
        if budget * weight < most * total:
            return out | {n: budget * nodes[n][1] // total for n in order}
        out[order.pop(0)] = most
        budget -= most
    return out


def plain(rows, weights, percent, epochs, seed):
    """Sorted (doc_id, copies) for rows of (doc_id, text, path of three)."""
    rows = [(i, t, p, len(words(t))) for i, t, p in rows if words(t)]
    supply = {}
    for _, _, p, n in rows:
        for depth in range(4):
            supply[p[:depth]] = supply.get(p[:depth], 0) + n
    budget = {(): supply.get((), 0) * percent // 100}
    for depth in range(3):
        for parent in [p for p in budget if len(p) == depth]:
            nodes = {p: (supply[p] * epochs, weights.get("/".join(p), 1)) for p in supply
                     if len(p) == depth + 1 and p[:-1] == parent}
            budget |= divided(budget[parent], nodes)
    out = []
    for leaf in [p for p in budget if len(p) == 3]:
        full, rest = divmod(budget[leaf], supply[leaf])
        key = lambda r: (hashlib.md5(f"{seed}:{full}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[3], r[1])  # noqa: E731, B023
        upto = 0
        for i, t, _, n in sorted((r for r in rows if r[2] == leaf), key=key):
            upto += n
            if copies := full + (rest > 0 and upto <= rest):
                out.append((i, copies))
    return sorted(out, key=str)


def mixed(spark, rows, weights, percent, epochs, seed):
    docs = spark.createDataFrame([(i, t, *p) for i, t, p in rows], "doc_id long, text string, d string, l string, s string")
    out = m.mix(docs, {c: F.col(c) for c in "dls"}, weights, percent, epochs, seed)
    assert out.columns == [*docs.columns, "n_tokens", "copies"]
    return sorted(((r.doc_id, r.copies) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed,percent,epochs", [(1, 100, 4), (2, 30, 1), (3, 250, 3), (4, 1000, 2)])
def test_random_trees(spark, seed, percent, epochs):
    r = random.Random(seed)
    paths = [(d, l, s) for d in "ab" for l in "xyz" for s in "123" if r.random() < 0.7]
    rows = [(i if i % 50 else None, " ".join("w" * r.randint(0, 12)), r.choice(paths[:1] + paths)) for i in range(400)]
    weights = {"a": r.randint(1, 9), "b": r.randint(0, 9), "a/x": 5, "b/y": 0, "a/x/1": 7, "b/z/3": 3}
    assert mixed(spark, rows, weights, percent, epochs, seed) == plain(rows, weights, percent, epochs, seed)


@pytest.mark.parametrize("rows,digits", [(0, 3), (20_000 * 4096, 3), (20_000 * 4096 + 1, 4), (10 ** 10, 5)])
def test_buckets_grow_with_the_largest_leaf(rows, digits):
    assert m.bucket_digits(rows) == digits


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_any_number_of_buckets_selects_the_same(spark, monkeypatch, digits):
    r = random.Random(digits)
    rows = [(i // 3, " ".join("w" * r.randint(0, 9)), ("a", "x", r.choice("12"))) for i in range(300)]
    monkeypatch.setattr(m, "BUCKET_DIGITS", digits)
    assert mixed(spark, rows, {"a/x/1": 3}, 120, 2, 5) == plain(rows, {"a/x/1": 3}, 120, 2, 5)


def test_shortage_goes_to_siblings_before_ancestors():
    """The language b/y can use little: its sibling b/x gets the rest, and the domain a nothing of it."""
    got = divided(100, {"a": (1000, 1), "b": (1000, 1)})
    assert got == {"a": 50, "b": 50}
    assert divided(got["b"], {"x": (900, 1), "y": (5, 9)}) == {"y": 5, "x": 45}
    assert divided(100, {"a": (1000, 1), "b": (20, 1)}) == {"b": 20, "a": 80}


def test_edges(spark):
    docs = edge_docs(spark)
    out = m.mix_documents(docs)
    assert set(out.columns) == set(docs.columns)  # n_tokens and copies are replaced
    assert out.where("n_tokens = 0").count() == 0 and out.where("copies < 1").count() == 0
    assert m.mix_documents(empty_docs(spark)).count() == 0
    nulls = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    assert m.mix_documents(nulls).where("source IS NULL").count() > 0
