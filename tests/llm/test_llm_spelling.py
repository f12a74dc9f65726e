"""Spelling variants against plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ROWS, documents, edge_docs, empty_docs, lower
from meterflow.llm import spelling as s


def plain_words(rows, least_chars=s.LEAST_CHARS, least_n=s.LEAST_N, damage=s.DAMAGE):
    count = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            if len(run) >= least_chars:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if damage and h % damage == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= least_chars:
                    count[run] += 1
    return {w: n for w, n in count.items() if n >= least_n}


def near(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(count, ratio=s.RATIO):
    """{(word, form, root, n, n_near, form_n)}."""
    form, size = {}, {}
    for w, n in count.items():
        around = [v for v in count if near(v, w)]
        size[w] = len(around)
        best = min(around, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, size[w], count[form[w]] if form[w] else None) for w, n in count.items()}


def variants(spark, count, ratio=s.RATIO):
    rows = s.group_variants(spark.createDataFrame(list(count.items()), "word string, n long"), ratio).collect()
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows]
    assert len(got) == len(set(got)) == len(count)
    return set(got)


@pytest.mark.parametrize("ranges", [None, 3])
def test_random_words(spark, monkeypatch, ranges):
    """Short words of few letters, with runs and ties; also in ranges of a few words whose borders are cut short."""
    if ranges:
        monkeypatch.setattr(s, "RANGE", ranges)
        monkeypatch.setattr(s, "BORDER_CHARS", 2)
    pick = random.Random(5)
    words = {"".join(pick.choice("abé😀") for _ in range(pick.randrange(1, 7))) for _ in range(250)}
    words |= {"a" * k for k in range(1, 40)} | {"a" * 3000, "a" * 2999, "a" * 1500 + "b" + "a" * 1499}
    count = {w: pick.choice([1, 1, 2, 5, 5, 25, 125, 130, 700]) for w in sorted(words)}
    assert variants(spark, count) == plain(count)
    assert variants(spark, {}) == set()


def test_forms_lead_to_the_last_root(spark):
    """A chain of forms, ties between neighbours, and frequencies one below the ratio."""
    chain = {"word" + "x" * k: 6 ** k for k in range(9)}
    ties = {"tie": 1, "tia": 5, "tib": 5, "tiee": 4, "abcd": 10, "abce": 49, "bcde": 10, "bcdf": 50}
    got = variants(spark, {**chain, **ties})
    assert got == plain({**chain, **ties})
    assert {r[2] for r in got if r[0].startswith("word")} == {"word" + "x" * 8}


@pytest.mark.parametrize("damage", [0, 2, s.DAMAGE])
def test_words_of_awkward_texts(spark, damage):
    rows = ROWS + [(20 + k, t) for k, t in enumerate(
        ["ÀÉÿ×÷abc ŸŸŸŸŸŸ straße_straße", "word1wordword2", "ABCDEFÄ abcdefä", "abc'defghi-jklmno", "naïve naïves Naïve"])]
    found = {r.word: r.n for r in s.words(edge_docs(spark, rows), least_chars=3, least_n=1, damage=damage).collect()}
    assert found == plain_words(rows, 3, 1, damage)
    assert s.group_variants(s.words(edge_docs(spark, rows), least_chars=3, least_n=1)).count() == len(plain_words(rows, 3, 1))
    assert s.group_variants(s.words(empty_docs(spark))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=6), min_size=1), st.integers(1, 6), st.integers(1, 6))
def test_a_node_has_one_number_in_all_ranges(words, ranges, chars):
    words = sorted(words)
    borders = s.Borders([w[:chars] for w in words], ranges)
    nodes = {}
    by_part = sorted((borders.range_of(w), w) for w in words)
    assert [w for _, w in by_part] == words
    numbers = {}
    for part, w in by_part:
        # a range is read by a task of its own
        path = numbers.setdefault(part, s.Numbers(borders)).nodes(part, w)
        assert len(path) == len(w) + 1
        for k, node in enumerate(path):
            assert nodes.setdefault(w[:k], node) == node
    assert len(set(nodes.values())) == len(nodes)


def test_whole_table(spark, sf):
    from meterflow.llm.queries import QUERIES
    want = plain(plain_words(documents(spark, sf, "doc_id", "text")))
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in QUERIES["op11_spelling"](spark, sf).collect()]
    assert set(got) == want and len(got) == len(want) and any(r[1] for r in got)
