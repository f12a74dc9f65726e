"""Line dedup against a plain version."""

import hashlib

import pytest

from cases import LONG, ROWS, SCHEMA, documents, edge_docs, empty_docs, extras_kept
from meterflow.llm import line_dedup as d


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))


def plain(rows, min_chars=10):
    """(doc_id, n_lines, n_dropped, text) of each row; a null id is one document, the last."""
    order = lambda i: (i is None, i)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(k := key_of(line)) >= min_chars:
                holders.setdefault(k, set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(holders.get(key_of(x), ())) < 2 or min(holders[key_of(x)], key=order) == i]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


def result(docs):
    out = d.dedup_lines(docs)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in out.collect()), key=str)


MORE = [(20, "same long line\nother long line\nsame long line"), (21, "  SAME long line\t\nown line number one"),
        (22, "same long line"), (22, "same long line"), (None, "same long line\nlast line of all"), (23, LONG + "\n" + LONG),
        (24, "only ten!!"), (25, "only ten!!"), (26, "nine chrs"), (27, "nine chrs"), (28, "éééééééééé"), (29, "éééééééééé"),
        (30, "\n\n\n"), (31, "same long line")]


def test_edges(spark):
    rows = ROWS + MORE
    docs = edge_docs(spark, rows)
    assert result(docs) == plain(rows)
    extras_kept(d.dedup_lines(docs), ["n_lines"])


@pytest.mark.parametrize("bits", [1 << 20, 1 << 21])
def test_a_full_filter_changes_nothing(spark, monkeypatch, bits):
    """More lines are suspected, none is dropped wrongly."""
    monkeypatch.setattr(d, "SLICE_BITS", 1 << 10)
    monkeypatch.setattr(d, "MOST_BITS", 1 << 10)
    rows = [(i, f"line number {i}\nshared line {i % 40}\nanother line {i // 3}") for i in range(2000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(docs) == plain(rows)


def test_whole_table(spark, sf):
    rows = documents(spark, sf, "doc_id", "text")
    from meterflow.llm.queries import QUERIES
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in QUERIES["op8_line_dedup"](spark, sf).collect()}
    assert got == {i: (n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in plain(rows)}


def test_empty_table(spark):
    assert d.dedup_lines(empty_docs(spark)).count() == 0
