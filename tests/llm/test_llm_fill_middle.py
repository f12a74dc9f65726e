"""Fill-in-the-middle forms against plain cutting, and exact round trips."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa

from cases import LONG, ROWS, SCHEMA, documents, edge_docs, empty_docs, extras_kept
from meterflow.llm import fill_middle as f


def plain(key, text, seed=1, rate=f.RATE, spm=f.SPM):
    """(n, form, prefix_chars, middle_chars, output)."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in f.SENTINELS) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm_form = h[3] % 100 < spm
    out = f"<S>{s}<P>{p}<M>{m}" if spm_form else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if spm_form else "psm", len(p), len(m), out


#: sentinels and things that are nearly sentinels, at the borders of texts too
TRICKY = [(20 + i, t) for i, t in enumerate([
    "a<P>b", "<S>", "<M> at the head", "at the end <M>", "<", "<P", "P>", "><", "<P<S", "S><M", "<<P", "<p>", "a < b > c",
    "P>", "<", "M>x", "1 2 3", "ä", "éa1é", "a" * 50, "<P", ">", "<S", ">"])]


@pytest.mark.parametrize("settings_", [{}, {"rate": 100, "spm": 50}, {"rate": 100, "spm": 0, "seed": 7}, {"rate": 0}])
def test_edges(spark, settings_):
    rows = ROWS + TRICKY
    out = f.restore(f.fill_in_middle(edge_docs(spark, rows), **settings_))
    names = ("n", "form", "prefix_chars", "middle_chars", "output")
    key = lambda r: tuple(str(x) for x in r)
    got = out.collect()
    assert sorted(((r.doc_id, r.text, *[r[c] for c in names]) for r in got), key=key) == sorted(
        ((i, t, *plain(i, t, **settings_)) for i, t in rows), key=key)
    for r in got:
        assert r.restored == (r.text or "")
        assert r.output_sha256 == hashlib.sha256(r.output.encode()).hexdigest()
    extras_kept(out)


def test_empty_table_and_column_names(spark):
    assert f.restore(f.fill_in_middle(empty_docs(spark))).count() == 0
    docs = spark.createDataFrame([(1, "one two", "x", "y")], SCHEMA + ", FORM string, Output string")
    row = f.restore(f.fill_in_middle(docs)).first()
    assert row.restored == "one two" and (row["form"], row["output"]) == plain(1, "one two")[1::3]
    assert "output" not in f.fill_in_middle(docs.select("doc_id", "text"), text=False).columns


def test_texts_that_are_not_arranged_stay_unrestored(spark):
    rows = [("psm", "<P>a<S>b<M>c", "acb"), ("spm", "<S>a<P>b<M>c", "bca"), ("plain", "<P>a", "<P>a"), ("psm", "<S>a<P>b<M>c", None),
            ("spm", "x<S>a<P>b<M>c", None), ("psm", "<P>a<S>b", None), ("psm", "", None), ("psm", None, None),
            ("plain", None, ""), ("other", "a", None), (None, "a", None)]
    docs = spark.createDataFrame(rows, "form string, output string, want string")
    for r in f.restore(docs).collect():
        assert r.restored == r.want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ1 é😀<>PSM\n", max_size=12), min_size=1, max_size=5), st.randoms())
def test_any_cut_restores(texts, random):
    """Every arrangement of every cut is undone, and hashes as the text it stands for."""
    column = pa.array(texts)
    table = f.PieceTable(column)
    units = [re.findall(r"[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert len(table.unit_starts()) == sum(map(len, units))
    held = (table.sentinel_at() >= 0)
    assert held.tolist() == [[s in t for s in f.SENTINELS] for t in texts]
    points = [sorted(len("".join(u[:random.randint(0, len(u))]).encode()) for _ in range(2)) for u in units]
    at = np.array(points) + table.offsets[:-1, None]
    table.cut(at[:, 0], at[:, 1])
    free = ~held.any(axis=1)
    table.add_sentinels(free)
    form = np.array([random.choice([1, 2]) if x else 0 for x in free])
    table.permute(np.array([f.ARRANGEMENTS[x] for x in f.FORMS])[form])
    out = table.texts()
    assert table.sha256().to_pylist() == [hashlib.sha256(t.encode()).hexdigest() for t in out.to_pylist()]
    batch = pa.RecordBatch.from_arrays([out, pa.array([f.FORMS[x] for x in form])], names=["output", "form"])
    back = [t for b in f._restored("back")([batch]) for t in b.column("back").to_pylist()]
    assert back == texts


def test_whole_table(spark, sf):
    from meterflow.llm.queries import QUERIES
    rows = documents(spark, sf, "doc_id", "text")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {(i, n, form, p, m, sha(out), sha(t or "")) for i, t in rows for n, form, p, m, out in [plain(i, t)]}
    got = [tuple(r) for r in QUERIES["op13_fill_middle"](spark, sf).collect()]
    assert set(got) == want and len(got) == len(rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"} and len(LONG) > 100_000
