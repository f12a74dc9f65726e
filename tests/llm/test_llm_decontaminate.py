"""Benchmark decontamination against a plain search for every window."""

import random

import pytest
from pyspark.sql import functions as F

from cases import LONG, ROWS, alnum_words, edge_docs, empty_docs, extras_kept
from meterflow.llm import decontaminate as d
from meterflow.llm import item_shards as s


def plain(texts, items, window):
    """For each text: words, hit words and item ids, by looking at every place."""
    grams = {}
    for name, text in items:
        w = alnum_words(text)
        for n, i in [(window, i) for i in range(len(w) - window + 1)] if len(w) >= window else [(len(w), 0)] * bool(w):
            grams.setdefault(tuple(w[i:i + n]), set()).add("" if name is None else str(name))
    sizes = {len(g) for g in grams}
    out = []
    for text in texts:
        w, hit, found = alnum_words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if names := grams.get(tuple(w[i:i + n])):
                    hit |= set(range(i, i + n))
                    found |= names
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_random_words_against_plain(spark, seed):
    r = random.Random(seed)
    word = lambda n: " ".join(r.choices("abc", k=n))  # noqa: E731  few words, so that windows overlap in every way
    items = [(i, word(r.choice([0, 1, 2, 3, 4, 5, 8, 12]))) for i in range(8)]
    texts = [word(r.randint(0, 40)) + r.choice(["", " x ", "-Q-"]) + word(r.randint(0, 9)) for _ in range(40)]
    index = d.Index.of_texts([str(i) for i, _ in items], [t for _, t in items], 4)
    import pyarrow as pa
    counts, spans, found = index.match(pa.array(texts))
    got = [(n, sum(e - b for b, e in s), sorted(f)) for n, s, f in zip(counts, spans, found)]
    assert got == plain(texts, items, 4)


def test_edges_and_several_automata(spark, monkeypatch):
    items = [(1, "alpha beta gamma delta"), (2, ""), (3, None), (None, "one"), (4, LONG), (1, "alpha beta gamma delta"),
             (5, "日本")]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = edge_docs(spark)
    expected = plain([r.text for r in docs.collect()], items, 13)
    for most in (d.MOST_CHARS, 50_000):  # the second deals the items into several automata
        monkeypatch.setattr(d, "MOST_CHARS", most)
        found = d.find_matches(docs, table)
        rows = found.collect()
        assert [(r.n_words, r.n_hit, r["items"]) for r in rows] == expected
        extras_kept(found, ["n_words", "items", "hits"])


def test_decisions(spark):
    items = spark.createDataFrame([(1, "p q r s t u v w x y z a b")], "item_id long, text string")
    clean = " ".join(f"w{i}" for i in range(400))
    docs = spark.createDataFrame([(1, "P q r s t u v w x y z a b! end"), (2, clean + " p q r s t u v w x y z a b"),
                                  (3, clean), (4, None)], "doc_id long, text string")
    assert {r.doc_id for r in d.drop_contaminated(docs, items).collect()} == {2, 3, 4}
    cut = {r.doc_id: r.text for r in d.cut_spans(docs, items).collect()}
    assert cut == {1: "! end", 2: clean + " ", 3: clean, 4: None}
    assert {r.doc_id: r.text for r in d.cut_spans(docs, items, longest=13).collect()}[1].startswith("P q")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.find_matches(empty_docs(spark), none).count() == 0
    assert d.find_matches(edge_docs(spark), none).where("n_hit > 0").count() == 0
    assert d.find_matches(edge_docs(spark), none).select(F.sum("n_words")).first()[0] > 0


@pytest.mark.parametrize("window", [4, 13])
def test_items_in_shards(spark, monkeypatch, window):
    """Too many items for broadcast automata: dealt with their runs, against plain; a long item is cut into pieces."""
    monkeypatch.setattr(d, "MOST_CHARS", 400)
    monkeypatch.setattr(s, "PIECE", 50)
    monkeypatch.setattr(s, "RUN_WORDS", 300)
    r = random.Random(window)
    word = lambda n: " ".join(r.choices([f"w{i}" for i in range(60)], k=n))
    items = [(i, word(r.choice([1, 2, 5, 14, 30, 400]))) for i in range(30)]
    items += [(40, "alpha beta"), (None, "日本 words"), (41, ""), (42, None), (0, items[0][1]), (43, items[1][1])]
    rows = list(ROWS)
    for i in range(300):
        t = items[r.randrange(30)][1].split()
        begin = r.randrange(len(t))
        text = word(r.randint(0, 30)) + " " + " ".join(t[begin:begin + r.choice([3, 13, 20, 200])]) + " clean words"
        rows += [(100 + i, text.upper() if i % 3 else text)] * r.choice([1, 1, 3])
    rows += [(500 + i, " ".join(f"c{i}x{k}" for k in range(30))) for i in range(20)]
    found = d.find_matches(edge_docs(spark, rows).repartition(4), spark.createDataFrame(items, "item_id long, text string"), window)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=str)
    assert got == sorted(((i, *p) for (i, _), p in zip(rows, plain([t for _, t in rows], items, window))), key=str)
    assert sum(r[2] > 0 for r in got) > 100
    extras_kept(found, ["n_words", "items", "hits"])
    assert d.find_matches(empty_docs(spark), spark.createDataFrame(items, "item_id long, text string"), window).count() == 0


def test_a_full_filter_of_windows_changes_nothing(spark, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(f"i{i}x{k}" for k in range(20))) for i in range(400)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(i, f"some text {i} " + " ".join(f"i{i}x{k}" for k in range(i % 20))) for i in range(400)], "doc_id long, text string")
    want = sorted((r.doc_id, r.n_hit, r.hits, r["items"]) for r in d.find_matches(docs, items).collect())
    monkeypatch.setattr(d, "MOST_CHARS", 2000)
    for most in (s.MOST_BITS, s._PART):
        monkeypatch.setattr(s, "MOST_BITS", most)
        assert sorted((r.doc_id, r.n_hit, r.hits, r["items"]) for r in d.find_matches(docs, items).collect()) == want
