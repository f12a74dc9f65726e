"""The Jaccard join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cases import ROWS, SCHEMA, edge_docs, empty_docs, words
from meterflow.llm import jaccard as j
from meterflow.llm.components import components


def shingles(text, size=3):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def plain(rows, percent=90, size=3):
    """Sorted (doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    out = []
    for x, (i, _) in enumerate(rows):
        own = [rows[y][0] for y in range(len(rows)) if root(y) == root(x) and rows[y][0] is not None]
        out.append((i, len(sets[x]), (min(own) if own else None) if sets[x] else i))
    return sorted(out, key=str)


def near_copies(seed, n=120):
    """Texts of many sizes, with copies that differ in a few words, right around the limit."""
    r = random.Random(seed)
    rows, common = [], " ".join(f"common{i}" for i in range(40))
    while len(rows) < n:
        base = [f"w{r.randint(0, 5000)}" for _ in range(r.choice([1, 2, 3, 5, 9, 12, 20, 45, 90, 200, 400]))]
        if r.random() < 0.3:
            base += common.split()
        for _ in range(r.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 25))):
                text[r.randrange(len(text))] = f"x{r.randint(0, 10**6)}"
            rows.append((len(rows), " ".join(text)))
    r.shuffle(rows)
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("percent", [90, 80])
def test_search_and_signatures_against_all_pairs(seed, percent):
    """Without Spark: every linked pair shares a signature and is found by the search."""
    rows = near_copies(seed, 300)
    sets = j.shingle_sets(pa.array([t for _, t in rows]))
    bands = j.Bands(percent)
    keys = [set(bands.signatures(s).tolist()) for s in sets]
    search, linked = j.Search(sets, percent), 0
    for a in range(len(sets)):
        found = set(search.linked(sets[a]).tolist())
        for b in range(len(sets)):
            same = len(np.intersect1d(sets[a], sets[b]))
            want = 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same)
            assert (b in found) == want
            assert not want or keys[a] & keys[b]
            linked += want
    assert linked > len(sets)


@pytest.mark.parametrize("block", [j.BLOCK, 300])
def test_near_copies(spark, block):
    """The second block size deals every larger group into blocks."""
    rows = near_copies(7) + [(900 + i, " ".join(f"g{k}" for k in range(40) if k != i)) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(j.jaccard_components(docs, block=block)) == plain(rows)


def test_edges(spark):
    docs = edge_docs(spark)
    assert result(j.jaccard_components(docs)) == plain(ROWS)
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 3, 4, 5, 6, 7, None, 9, 10, 11, 12, 13], key=str)


def test_empty_table(spark):
    assert j.jaccard_components(empty_docs(spark)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


@pytest.mark.parametrize("hot", [j.HOT, 2])
def test_candidate_pairs_hold_all_links(hot, monkeypatch):
    """Without Spark: linked sets share what the pairs ask for, or a frequent shingle, whatever counts as frequent."""
    monkeypatch.setattr(j, "HOT", hot)
    sets = j.shingle_sets(pa.array([t for _, t in near_copies(3, 300)]), 5)
    sets = list({j.digest(s): s for s in sets if len(s)}.values())
    codes, counts = np.unique(np.concatenate(sets), return_counts=True)
    for often in (codes[:0], codes[counts > 4]):
        prefixes = j.Prefixes(80, often, counts[np.searchsorted(codes, often)])
        parts = [prefixes.of(s) for s in sets]
        node = np.repeat(np.arange(len(sets)), [len(rare) for rare, _ in parts])
        key = np.concatenate([rare for rare, _ in parts]).view(np.int64)
        order = np.argsort(key)
        n = np.array([len(s) for s in sets])
        times, least = {}, {}
        for u, v, need in zip(*(c.tolist() for c in prefixes.pairs(key[order], node[order], n[node[order]]))):
            pair = max(u, v), min(u, v)
            times[pair], least[pair] = times.get(pair, 0) + 1, min(need, least.get(pair, need))
        forest, linked = j.Forest(len(sets)), 0
        for pair, count in times.items():
            if count >= least[pair]:
                forest.join(pair[0], np.array([pair[1]]))
        for a in range(len(sets)):
            for b in range(a):
                same = len(np.intersect1d(sets[a], sets[b]))
                if 100 * same >= 80 * (n[a] + n[b] - same):
                    linked += 1
                    assert forest.root(a) == forest.root(b) or set(parts[a][1].tolist()) & set(parts[b][1].tolist())
        assert linked > 50


@pytest.mark.parametrize("block", [j.BLOCK, 300])
def test_near_copies_of_the_pipelines_rule(spark, block):
    rows = near_copies(5, 200) + [(900 + i, " ".join(f"g{k}" for k in range(60) if k != i)) for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(j.jaccard_components(docs, 80, 5, block)) == plain(rows, 80, 5)


def test_one_of_repeated_rows_whatever_their_order(spark):
    """Rows of one id that differ in other columns only: always the same one stays; a second text of the id stays too."""
    rows = [(1, "alpha beta gamma delta", f"v{i}") for i in range(6)] + [(1, "other words for the id", None)] * 2
    rows += [(2, "ALPHA beta gamma delta", "v"), (3, "words of its own", "v"), (None, "no id at all", "v")]
    kept = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, version string").repartition(3)
        kept.append(sorted((tuple(r) for r in j.keep_one(docs).collect()), key=str))
    assert kept[0] == kept[1] == kept[2]
    assert sorted((r[:2] for r in kept[0]), key=str) == sorted(
        [(1, "alpha beta gamma delta"), (1, "other words for the id"), (3, "words of its own"), (None, "no id at all")],
        key=str)


def test_frequent_shingles_are_counted_over_all_texts(spark):
    """In 24 of 500 texts or more is frequent, wherever these texts are."""
    rows = [(i, f"a{i} b{i} c{i} " + "x y z " * (i % 20 == 0) + "p q r" * (i % 25 == 0)) for i in range(500)]
    codes, counts = j._frequent(spark.createDataFrame(rows, SCHEMA).repartition(7), 3)
    wanted = j.shingle_sets(pa.array(["x y z"]))[0]
    assert codes.tolist() == wanted.tolist() and counts.tolist() == [25]
