"""Word codes against plain words."""

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import ROWS, alnum_words, words
from meterflow.llm import words as w

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbZé日 \n\t,.1\x00 "), max_size=30)), max_size=8)


def by_word(texts, table, plain):
    codes, counts = w.codes_of(pa.array(texts, pa.string()), table)
    expected = [plain(t) for t in texts]
    assert list(counts) == [len(e) for e in expected]
    seen = {}
    for word, code in zip((x for e in expected for x in e), codes):
        assert seen.setdefault(word, code) == code
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_codes_stand_for_words(texts):
    by_word(texts, w.SPACE, words)
    by_word(texts, w.NOT_ALNUM, alnum_words)


def test_long_texts_and_slices():
    texts = [t for _, t in ROWS] * 3
    by_word(texts, w.SPACE, words)
    whole, counts = w.codes_of(pa.array(texts, pa.string()))
    part, some = w.codes_of(pa.array(texts, pa.string()).slice(3, 7))
    ends = np.cumsum(counts)
    assert (part == whole[ends[2]:ends[9]]).all() and (some == counts[3:10]).all()


def test_empty_column():
    codes, counts = w.codes_of(pa.array([], pa.string()))
    assert len(codes) == 0 and len(counts) == 0
