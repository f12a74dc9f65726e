"""Language-model scores against plain counting."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cases import ROWS, SCHEMA, documents, edge_docs, empty_docs, extras_kept, remainder, words
from meterflow.llm import backoff as b


def model(rows, train, strengths=b.STRENGTHS):
    """P(w | two words before), and the words' counts: by plain counting. None is the end, 0 the beginning."""
    texts = [[*words(t), None] for i, t in rows if train(i)]
    one = Counter(w for t in texts for w in t)
    two = Counter(p for t in texts for p in zip([0, *t], t))
    three = Counter(p for t in texts for p in zip([0, *t], t, t[1:]))
    n, v = sum(one.values()), len(one)
    once, twice = (sum(c == k for c in one.values()) for k in (1, 2))
    d = once / (once + 2 * twice) if once else 0.5

    def p(w, before):
        lower = ((one[w] - d) / n if one[w] else d * v / n) if n else 1.0
        h = before[-1]
        lower = (two[h, w] + strengths[0] * lower) / ((len(texts) if h == 0 else one[h]) + strengths[0])
        if len(before) == 1:
            return lower
        return (three[*before, w] + strengths[1] * lower) / (two[before] + strengths[1])

    return p, one


def plain(rows, train, strengths=b.STRENGTHS):
    """For each text: tokens, known tokens, training tokens, base score and score."""
    p, one = model(rows, train, strengths)
    n, v, out = sum(one.values()), len(one), []
    for _, t in rows:
        t = [*words(t), None]
        before = [(0,), *zip([0, *t], t)]
        out.append((len(t), sum(one[w] > 0 for w in t), n, sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t),
                    sum(math.log10(p(w, h)) for w, h in zip(t, before))))
    return out


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:3] == w[:3]
        assert g[3:] == pytest.approx(w[3:], rel=1e-9, abs=1e-9)


FIGURES = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


@pytest.mark.parametrize("block", [b.BLOCK, 4000])
def test_edges(spark, block):
    docs = edge_docs(spark)
    train = lambda i: i is not None and i % 3 != 0
    scored = b.score(docs, F.col("doc_id") % 3 != 0, block=block)
    got = sorted((str(r.doc_id), str(r.text), *[r[f] for f in FIGURES]) for r in scored.collect())
    want = sorted((str(i), str(t), *f) for (i, t), f in zip(ROWS, plain(ROWS, train)))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    same([g[2:] for g in got], [w[2:] for w in want])
    extras_kept(scored, FIGURES)


def test_no_training_texts_and_empty_table(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = b.score(docs, F.lit(False)).collect()
    assert len(rows) == len(ROWS) and all(r.n_known == 0 and r.score == 0 and r.base_score == 0 for r in rows)
    assert b.score(empty_docs(spark), F.lit(True)).count() == 0


def test_what_follows_a_state_adds_up_to_one():
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(1, 30))) for i in range(30)]
    p, one = model(rows, lambda i: True)
    unseen = 1 - sum(p(w, (0,)) for w in one)
    for before in ((0,), ("w1",), (0, "w1"), ("w1", "w2"), ("w1", "never"), ("never",)):
        assert sum(p(w, before) for w in one) == pytest.approx(1 - unseen * (p("new", before) / p("new", (0,))), abs=1e-9)


@pytest.mark.parametrize("block", [300, 3000, b.BLOCK])
def test_counts_do_not_depend_on_the_blocks(spark, block):
    """Triples that one block alone has, that several share, and that only texts to be scored have."""
    rows = [(i, " ".join(f"w{(i * k * k) % (5 + i % 40)}" for k in range(1, 40))) for i in range(60)]
    rows += [(100 + i, "a b c a b c d") for i in range(6)] + [(200 + i, f"a b c x{i} a b c") for i in range(6)]
    train = lambda i: i % 3 != 0
    got = {r.doc_id: tuple(r[f] for f in FIGURES) for r in b.score(
        spark.createDataFrame(rows, SCHEMA), F.col("doc_id") % 3 != 0, block=block).collect()}
    want = plain(rows, train)
    same([got[i] for i, _ in rows], want)


def test_a_text_that_occurs_twice_scores_higher(spark):
    """Per token, against the same text trained on once; both as single words are equally common."""
    base = [f"w{k}" for k in range(400)]
    order = lambda seed: " ".join(sorted(base, key=lambda w: hash_of(seed, w)))
    rows = [(i, order(i // 2 if i < 20 else i)) for i in range(60)]
    got = {r.doc_id: r.score for r in b.score(spark.createDataFrame(rows, SCHEMA), F.lit(True)).collect()}
    assert min(got[i] for i in range(20)) > max(got[i] for i in range(20, 60))


def hash_of(seed, word):
    return zlib.crc32(f"{seed}:{word}".encode())


def test_whole_table(spark, sf):
    from meterflow.llm.queries import QUERIES
    rows = documents(spark, sf, "doc_id", "text")
    want = dict(zip((i for i, _ in rows), plain(rows, lambda i: remainder(i, 7) != 2)))
    got = QUERIES["op4_backoff"](spark, sf).collect()
    assert {r.doc_id: r.held_out for r in got} == {i: remainder(i, 7) == 2 for i in want}
    same([tuple(r[f] for f in FIGURES) for r in got], [want[r.doc_id] for r in got])
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
