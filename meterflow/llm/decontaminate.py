"""Find and remove passages of benchmark items in training texts.

The words of all items make one generalised suffix automaton. The words of a
text are streamed through it; its state keeps the longest match that ends at the
word, and where that match holds a window, the window's words are hit. A window
is WINDOW consecutive words of an item; an item with fewer, but not none, is one
window as a whole. Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing
A-Z, compared by 64-bit codes.

Null and empty texts have no words. An item with no words matches nothing; items
with the same id count once; a null id counts as the empty text. Without items
nothing is hit. Rows repeat as they come, and other columns pass through.
"""

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.item_shards import find_in_shards
from meterflow.llm.labelled import text_of
from meterflow.llm.shared import Shared
from meterflow.llm.words import NOT_ALNUM, by_batch, codes_of, joined, schema_with, with_columns, word_spans

WINDOW = 13
#: A text is contaminated if at least one word in COVERAGE is hit.
COVERAGE = 20
#: Characters of items in one automaton at most (about 70 MB of memory). More items are dealt by
#: hash into several automata. The texts pass through each if they are MOST_PARTS or fewer; more
#: aren't broadcast, but get the runs of the texts that they may hold (`item_shards.py`).
MOST_CHARS, MOST_PARTS = 1_000_000, 8


class SuffixAutomaton:
    """All substrings of sequences of integers; `items` says which sequences hold a window."""

    def __init__(self, window: int):
        self.window, self.next, self.link, self.length = window, [{}], [-1], [0]
        #: sequences that hold the window of a state, or are a short window that ends there
        self.items: dict[int, set[str]] = {}
        self.whole: dict[int, set[str]] = {}
        self.shortest = window

    def _state(self, length: int, arcs: dict, link: int) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, c: int) -> int:
        """The state of exactly the strings of p followed by c, cut off from the longer ones."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c)
        return new

    def _window_state(self, state: int) -> int:
        """The suffix state whose strings include the one of `window` words."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def build(self, sequences: Iterable[tuple[str, list[int]]]) -> "SuffixAutomaton":
        sequences = list(sequences)
        for _, words in sequences:
            last = 0
            for c in words:
                last = self._extend(last, c)
        for name, words in sequences:
            state = 0
            for i, c in enumerate(words, 1):
                state = self.next[state][c]
                if i >= self.window:
                    self.items.setdefault(self._window_state(state), set()).add(name)
            if 0 < len(words) < self.window:
                self.whole.setdefault(state, set()).add(name)
                self.shortest = min(self.shortest, len(words))
        # the nearest short window among a state's proper suffixes
        self.short = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[state]
            self.short[state] = up if up in self.whole else self.short[up]
        return self

    def match(self, words: list[int], at: int, spans: list, found: set) -> None:
        """Stream `words`, of which the first has the place `at`; add hit spans and items."""
        state, length = 0, 0
        for i, c in enumerate(words, at + 1):
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if c not in self.next[state]:
                continue
            state, length = self.next[state][c], length + 1
            hit = 0
            if length >= self.window:
                hit = self.window
                found |= self.items[self._window_state(state)]
            short = state if state in self.whole and length == self.length[state] else self.short[state]
            while short > 0:
                hit = max(hit, self.length[short])
                found |= self.whole[short]
                short = self.short[short]
            if hit:
                begin = i - hit
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, i))


class Index:
    """An automaton over word codes, for text columns."""

    def __init__(self, ids: list[str], sequences: list[np.ndarray], window: int):
        self.vocabulary = np.unique(joined(sequences, np.uint64))
        self.automaton = SuffixAutomaton(window).build(
            (i, np.searchsorted(self.vocabulary, w).tolist()) for i, w in zip(ids, sequences))

    @classmethod
    def of_texts(cls, ids: list[str], texts: list[str], window: int) -> "Index":
        codes, counts = codes_of(pa.array(texts, pa.string()), NOT_ALNUM)
        return cls(ids, np.split(codes, np.cumsum(counts)[:-1]), window)

    def match(self, column: pa.Array):
        """For each text: its number of words, the hit spans (in words) and the items found."""
        return self.match_codes(*codes_of(column, NOT_ALNUM))

    def match_codes(self, codes: np.ndarray, counts: np.ndarray):
        spans, found = [[] for _ in counts], [set() for _ in counts]
        if not len(self.vocabulary) or not len(codes):
            return counts, spans, found
        at = np.minimum(np.searchsorted(self.vocabulary, codes), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == codes
        # only runs of the items' words that are as long as the shortest window can match
        bounds = np.concatenate([[0], np.cumsum(counts)])
        begin, end = known.copy(), known.copy()
        begin[1:] &= ~known[:-1]
        end[:-1] &= ~known[1:]
        filled = counts > 0
        begin[bounds[:-1][filled]] = known[bounds[:-1][filled]]
        end[bounds[1:][filled] - 1] = known[bounds[1:][filled] - 1]
        begin, end = np.flatnonzero(begin), np.flatnonzero(end) + 1
        long = end - begin >= self.automaton.shortest
        begin, end = begin[long], end[long]
        for doc, b, e in zip(np.searchsorted(bounds, begin, "right") - 1, begin, end):
            self.automaton.match(at[b:e].tolist(), int(b - bounds[doc]), spans[doc], found[doc])
        return counts, spans, found


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text less the characters from the first to the last word of each span."""
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]), NOT_ALNUM)
    out, at = [], 0
    for b, e in spans:
        out.append(text[at:starts[b]])
        at = ends[e - 1]
    return b"".join(out) + text[at:]


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with n_words, n_hit, hits (spans of words, flat: begin, end, ...) and items (ids, sorted)."""
    spark = docs.sparkSession
    items = items.select(text_of(F.col("item_id")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // MOST_CHARS))
    if parts > MOST_PARTS:
        return find_in_shards(docs, items, window, parts, Index, _merged)
    schema = schema_with(docs, n_words="long", n_hit="long", hits="array<long>", items="array<string>")
    out = docs
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id").collect()
        index = Shared(spark, Index.of_texts([r.item_id for r in rows], [r.text for r in rows], window))

        def work(batch, index=index, first=part == 0):
            counts, spans, found = index.value.match(batch.column("text"))
            if not first:
                for i, (old, ids) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())):
                    spans[i] = _merged(spans[i] + list(zip(old[::2], old[1::2])))
                    found[i] |= set(ids)
            hit = [sum(e - b for b, e in s) for s in spans]
            return with_columns(
                batch, drop=("n_words", "n_hit", "hits", "items"),
                n_words=pa.array(counts, pa.int64()), n_hit=pa.array(hit, pa.int64()),
                hits=pa.array([[x for s in spans_ for x in s] for spans_ in spans], pa.list_(pa.int64())),
                items=pa.array([sorted(f) for f in found], pa.list_(pa.string())))

        out = out.mapInArrow(by_batch(work), schema)
    return out


def is_contaminated(coverage: int = COVERAGE):
    return (F.col("n_hit") > 0) & (F.col("n_hit") * coverage >= F.col("n_words"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE) -> DataFrame:
    """The documents of which less than one word in `coverage` is hit, unchanged."""
    return find_matches(docs, items, window).where(~is_contaminated(coverage)).select(docs.columns)


def cut_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, longest: int = 0) -> DataFrame:
    """All documents, less the hit spans of more than `longest` words."""
    found, names = find_matches(docs, items, window), docs.columns

    def work(batch):
        new = batch.column("text").to_pylist()
        for i, flat in enumerate(batch.column("hits").to_pylist()):
            spans = [s for s in zip(flat[::2], flat[1::2]) if s[1] - s[0] > longest]
            if spans:
                new[i] = _without(new[i].encode(), spans).decode()
        text = pa.array(new, batch.column("text").type)
        return pa.RecordBatch.from_arrays([text if n == "text" else batch.column(n) for n in names],
                                          names=names)

    return found.mapInArrow(by_batch(work), docs.schema)
