"""Token counts against the tokenizers library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cases import documents, edge_docs, empty_docs, extras_kept
from meterflow.llm import token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as file:
    COUNTER = t.Counter(file.read(), {"the": 1}, {})


def plain(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


PARTS = ["a", "The", "é", "ñ", " ", "  ", "\n", "\t", "'s", "'re", "'", "!", "1", "23", "<|endoftext|>", " ", "\x1c",
         "\x85", "日本", "՘", "।", "😀", " ", "_", "\x00"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30).map("".join))
def test_any_text(text):
    assert COUNTER.count(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_texts_cut_into_pieces_and_a_full_cache(text):
    old = t.PIECE, t.CACHE
    t.PIECE, t.CACHE = 5, 3
    try:
        assert COUNTER.count(text) == plain(text)
    finally:
        t.PIECE, t.CACHE = old


def test_edges(spark):
    docs = edge_docs(spark)
    counted = t.count_tokens(docs, PATH)
    assert [r.n_tokens for r in counted.collect()] == [plain(r.text) for r in docs.collect()]
    extras_kept(counted, ["n_tokens"])
    assert t.count_tokens(empty_docs(spark), PATH).count() == 0


def test_whole_table(spark, sf):
    from meterflow.llm.queries import QUERIES
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op2_token_counts"](spark, sf).collect()}
    assert got == {i: (len((x or "").encode()), plain(x), plain(x) > 512) for i, x in documents(spark, sf, "doc_id", "text")}


def test_other_kinds_of_tokenizer_are_refused(spark):
    with pytest.raises(ValueError):
        t.count_tokens(edge_docs(spark), public_tokenizers.path("word_bpe_49k.json"))
