"""The pipeline against plain versions of its stages, and the queries that SQL can express."""

import pytest

import corpus_pipeline
from cases import LONG
from check_oracles import compare
from meterflow.llm import mixing, toxicity
from meterflow.llm.oracles import ORACLES
from test_llm_decontaminate import plain as hits
from test_llm_jaccard import plain as joined
from test_llm_line_dedup import plain as lines
from test_llm_mixing import plain as mixed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    same, detail = compare(spark, name, sf)
    assert same, detail


def planted():
    """Near copies on lines of their own, so that they reach the join whole: with 15% of words added, which
    is near enough by five words and 0.8 but not by three and 0.9, and with 30% added, which isn't."""
    rows = []
    for k in range(6):
        base = [f"w{k}x{i}" for i in range(200)]
        for j, added in enumerate((0, 30, 60)):
            text = " ".join(base + [f"n{k}x{j}x{i}" for i in range(added)])
            rows.append((900_000 + 10 * k + j, text, "en", "src1", len(text)))
    return rows


@pytest.fixture(scope="module")
def planted_sf(spark, sf, tmp_path_factory):
    """The tables of the pipeline with the planted documents."""
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs.unionByName(spark.createDataFrame(planted(), docs.schema)).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def expected(spark, docs, sf, percent=80, size=5):
    """(doc_id, text, copies) of the pipeline; the toxicity scores are the operator's, the rest is plain."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rest = {r.doc_id: r for r in toxicity.score(docs, model).collect() if r.score < toxicity.THRESHOLD}
    text = {i: t for i, _, _, t in lines([(i, r.text) for i, r in rest.items()])}
    kept = {i for i, _, c in joined(list(text.items()), percent, size) if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    order = sorted(kept)
    clean = [i for i, (n, h, _) in zip(order, hits([text[i] for i in order], items, 13)) if not (h and 20 * h >= n)]
    domains = {f"src{n}": name for name, numbers in mixing.DOMAINS.items() for n in numbers}
    rows = [(i, text[i], (domains.get(rest[i].source, "other"), rest[i].lang or "", rest[i].source or "")) for i in clean]
    copies = mixed(rows, mixing.WEIGHTS, mixing.PERCENT, mixing.MAX_EPOCHS, mixing.SEED)
    return sorted((i, text[i], c) for i, c in copies)


def test_pipeline_against_plain_stages(spark, planted_sf):
    docs = spark.read.parquet(f"{planted_sf}/documents.parquet")
    got = sorted((r.doc_id, r.text, r.copies) for r in corpus_pipeline.run(spark, planted_sf).collect())
    assert got == expected(spark, docs, planted_sf)
    # the rule of the join's own query would keep others, so this test can tell
    assert got != expected(spark, docs, planted_sf, 90, 3)


def test_every_stage_takes_awkward_rows(spark, sf):
    rows = [(1, None, None, None, None), (2, "", "en", "src1", 0), (3, LONG, "en", "src1", len(LONG)),
            (4, "one two three", "fr", "src19", 13), (4, "one two three", "fr", "src19", 13), (None, "four five six", None, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        out = some
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, sf)
            assert out.columns == COLUMNS
        last = corpus_pipeline.STAGES[-1][1](spark, out, sf)
        assert {r.doc_id for r in last.collect()} <= {r[0] for r in rows}


def test_a_registered_stage_list():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard", "decontaminate", "mixing"]


def test_near_duplicates_link_by_five_words_and_a_similarity_of_80_percent(spark, sf):
    """A copy with 15% of text added is a near duplicate, one with 30% added is not."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join(base + [f"x{i}" for i in range(30)]), " ".join(base + [f"y{i}" for i in range(60)])]
    docs = spark.createDataFrame([(i, t, "en", "src1", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["ngram_jaccard"](spark, docs, sf)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 2]
