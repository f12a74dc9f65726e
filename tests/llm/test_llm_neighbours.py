"""Neighbour search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterflow.llm import neighbours as nb


def plain(rows, is_query, k, dim):
    """Rows (query_id, rank, vec_id, score) by comparing everything."""
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) == dim and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = []
    for q in sorted({i for i, _ in good if is_query(i)}):
        own = np.array(min(tuple(v) for i, v in good if i == q))
        best = {}
        for i, v in good:
            if i != q:
                score = (v * own).sum() / (np.sqrt((v * v).sum()) * np.sqrt((own * own).sum()))
                best[i] = max(best.get(i, -2), score)
        near = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, rank, i, score) for rank, (i, score) in enumerate(near, 1)]
    return out


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_edges(spark):
    r = np.random.default_rng(1)
    rows = [(int(i), r.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    same = rows[3][1]
    rows += [(100 + i, same) for i in range(12)] + [(200, [0.0] * 8), (201, None), (202, [1.0]), (None, same),
             (203, [None] + same[1:]), (204, [float("nan")] + same[1:]), (205, [float("inf")] + same[1:]), (5, rows[5][1]),
             (10, rows[11][1]), (206, [2 * x for x in same]), (207, [-x for x in same]), (208, [])]
    df = spark.createDataFrame([(i, v, "kept", 1) for i, v in rows],
                               "vec_id long, embedding array<float>, score string, rank int").repartition(3)
    got = result(nb.nearest(df, F.col("vec_id") % 10 == 0, 5))
    assert got == plain([(i, v) for i, v in rows], lambda i: i % 10 == 0, 5, 8)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(nb, "QUERY_BLOCK", 7)
    r = np.random.default_rng(2)
    rows = [(int(i), r.normal(size=6).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(nb.nearest(df, F.col("vec_id") % 4 == 0, 3)) == plain(rows, lambda i: i % 4 == 0, 3, 6)


def test_few_candidates_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [r[:3] for r in result(nb.nearest(df, F.col("vec_id") == 0))] == [(0, 1, 1)]
    assert nb.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("dim", [1, 7, 64, 100])
def test_estimates_from_packed_bits_are_those_of_the_signs(dim):
    """Counting bits gives the inner product of the unpacked code and the rounded query."""
    r = np.random.default_rng(dim)
    rows, queries = r.normal(size=(50, dim)), r.normal(size=(9, dim))
    turn = nb.rotation(dim)
    codes, scalars = nb.encode(rows, turn)
    turned = nb.unit(queries) @ turn.T
    near = nb.Estimator(codes, scalars, dim)
    signs = np.unpackbits(codes, axis=1, count=dim) * 2.0 - 1
    for q, (bits, low, step) in enumerate(zip(*nb.planes(turned))):
        rounded = low + np.rint((turned[q] - low) / step) * step
        guess, bound = near(bits, low, step)
        assert guess == pytest.approx(signs @ rounded / (np.sqrt(dim) * scalars), abs=1e-9)
        unrounded = signs @ turned[q] / (np.sqrt(dim) * scalars)
        assert (np.abs(guess - unrounded) <= near.rounding * step + 1e-9).all() and (bound >= near.bound).all()


def test_estimates_lie_within_their_bounds():
    r = np.random.default_rng(3)
    rows, queries = r.normal(size=(4000, 64)), r.normal(size=(50, 64))
    turn = nb.rotation(64)
    near = nb.Estimator(*nb.encode(rows, turn), 64)
    found = [near(*asked) for asked in zip(*nb.planes(nb.unit(queries) @ turn.T))]
    guess, bound = (np.stack(x, axis=1) for x in zip(*found))
    off = guess - nb.unit(rows) @ nb.unit(queries).T
    assert (np.abs(off) > bound).mean() < 0.08 and abs(off.mean()) < 0.01


def test_recall_on_the_whole_table(spark, sf):
    from meterflow.llm.queries import QUERIES
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = plain(rows, lambda i: i % 50 == 0, 5, len(rows[0][1]))
    got = result(QUERIES["op10_nearest"](spark, sf))
    assert len(got) == len(want)
    found = {(q, i) for q, _, i, _ in got}
    assert sum((q, i) in found for q, _, i, _ in want) >= 0.9 * len(want)
    scores = {(q, i): s for q, _, i, s in want}
    assert all(s == scores[q, i] for q, _, i, s in got if (q, i) in scores)
