"""Language-model scores of texts from a weighted backoff automaton of order 3.

States are contexts of two words, one word, and none; a context is a state if it was seen in
training, and the state after a word is the longest such context. Arcs are n-grams
seen in training, from the state of all their words but the last. Every other state has a failure arc
to the context without its first word. With S2, S1 as STRENGTHS:

    arc of a state h:  (c(h w) + S * P(w | shorter h)) / (c(h) + S)
    failure arc:       S / (c(h) + S), followed by what the shorter context says
    word:              (c(w) - D) / N, or D * V / N for any word not seen, with D = n1 / (n1 + 2 n2)

so the weights of what can follow a state add up to 1. A text is read from left to right:
the state after a word is known from the state before and the word, the arc is taken or failure
arcs are followed until there is one, and the logarithms are added. As a state is made of the last
two words, numpy takes the step of every position of a block's texts at once, length by length.

Counts are of the whole corpus and too many for one machine, so the automaton is never
put together. Texts are dealt into blocks of about BLOCK bytes. Each block asks for
the counts of its own words and pairs, adding its training counts to the question;
shards of the code range add up the questions of all blocks and answer them, in the
order in which they were asked. Triples are asked for in a second round, but for
those with a pair that no other block asked for: their counts are the block's own. Then each
block has the part of the automaton that its texts can reach. A question or answer is one row for each
block and shard that have to do with each other. Words, pairs and triples are compared by 64-bit codes, which
travel sorted, as the gaps between them.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; each text ends with an end token.
Null and empty texts have the end token alone. Without training texts every token
is unknown and has probability 1. Repeated rows train and score as often as they occur.
Other columns pass through; those named like a new one are replaced.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.words import codes_of, joined, mix, schema_with, sliced, with_columns

BLOCK = 16 << 20
#: Weight of the shorter context's distribution against a state's own counts, by the length of the state less 1.
STRENGTHS = (600.0, 20.0)
#: Codes of the end token, and of the state in which a text begins.
END, BEGIN = np.uint64(1), np.uint64(2)
_PAIR, _TRIPLE = mix(np.array([3, 5], np.uint64)) | np.uint64(1)
#: In an answer: no other block asked for the n-gram, so the block's own count is the corpus's.
_ALONE = 0x80
_STATS = ("tokens", "words", "once", "twice")


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes in order, each once, and where each of the given ones is among them (a block has under 2^31)."""
    order = np.argsort(codes).astype(np.int32)
    ranked = codes[order]
    head = np.ones(len(codes), bool)
    head[1:] = ranked[1:] != ranked[:-1]
    at = np.empty(len(codes), np.int32)
    at[order] = np.cumsum(head, dtype=np.int32) - 1
    return ranked[head], at


class Tokens:
    """The tokens of a block's texts, and its distinct words, pairs and triples in the order of their codes."""

    def __init__(self, tables: Iterator[pa.RecordBatch]):
        codes, counts, train = [], [], []
        for batch in tables:
            for piece in sliced(batch, 4 << 20):
                c, n = codes_of(piece.column("text"))
                codes.append(c)
                counts.append(n)
                train.append(np.asarray(piece.column("__train").fill_null(False)))
        self.train = joined(train, bool)
        self.sizes = joined(counts, np.int64) + 1
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        token = np.empty(self.sizes.sum(), np.uint64)
        word = np.ones(len(token), bool)
        word[ends - 1] = False
        token[word], token[~word] = joined(codes, np.uint64), END
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.starts] = BEGIN
        learn = np.repeat(self.train, self.sizes)
        #: the state in which each text begins is the first of the words, as it were
        self.words, at = _distinct(np.concatenate([token, before[self.starts]]))
        self.word = at[:len(token)]
        state = np.empty_like(self.word)
        state[1:] = self.word[:-1]
        state[self.starts] = at[len(token):]
        self.state = state
        self.word_counts = np.bincount(at, np.concatenate([learn, self.train]), len(self.words)).astype(np.int64)
        pair = mix(before * _PAIR + token)
        del before
        self.pairs, self.pair = _distinct(pair)
        self.pair_counts = np.bincount(self.pair, learn, len(self.pairs)).astype(np.int64)
        #: positions with two words before them, the text's beginning counting as one; and the pair there
        inner = np.ones(len(token), bool)
        inner[self.starts] = False
        self.inner = np.flatnonzero(inner)
        self.context = self.pair[self.inner - 1]
        triple = mix(pair[self.inner - 1] * _TRIPLE + token[self.inner])
        del pair, token
        self.triples, self.triple = _distinct(triple)
        self.triple_counts = np.bincount(self.triple, learn[self.inner], len(self.triples)).astype(np.int64)
        #: the two pairs of each triple
        self.halves = np.empty(len(self.triples), np.int32), np.empty(len(self.triples), np.int32)
        self.halves[0][self.triple], self.halves[1][self.triple] = self.context, self.pair[self.inner]

    def shared_triples(self, alone: np.ndarray) -> np.ndarray:
        """Which triples another block may have: those with no pair that is this block's alone."""
        return ~(alone[self.halves[0]] | alone[self.halves[1]])


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that are the bytes between bounds (numbers of elements)."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1,
                                 [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def _numbers(column: pa.ChunkedArray | pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All elements of binary values end to end, and the number of each value's."""
    parts, sizes = [], []
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        c = c.cast(pa.large_binary())
        offsets = np.frombuffer(c.buffers()[1], np.int64)[c.offset:c.offset + len(c) + 1]
        if len(c) and offsets[-1] > offsets[0]:
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(dtype))
        sizes.append(np.diff(offsets) // np.dtype(dtype).itemsize)
    return joined(parts, dtype), joined(sizes, np.int64)


def _short(values: np.ndarray, bounds: np.ndarray, most: int, dtype) -> tuple[pa.Array, pa.Array]:
    """Numbers in few bytes; of those from `most` on, `most` and in a second column the number itself."""
    long = values >= most
    short = np.where(long, most, values).astype(dtype)
    return _binaries(short, bounds), _binaries(values[long].astype(np.uint32), np.concatenate([[0], np.cumsum(long)])[bounds])


def _whole(short: np.ndarray, long: np.ndarray, most: int) -> np.ndarray:
    out = short.astype(np.int64)
    out[short == most] = long
    return out


def _first_code(shard: np.ndarray, shards: int) -> np.ndarray:
    """The smallest code of a shard."""
    return (-(-(shard << 32) // shards)).astype(np.uint64) << np.uint64(32)


#: Codes as gaps, of which 32 bits, 16 bits and, of the few larger ones, all bits from the 32nd; then counts.
_QUESTION = pa.schema([("shard", pa.int64()), ("block", pa.int64()), *[(c, pa.binary()) for c in (
    "low", "high", "far", "count", "many")]])


def _questions(block: int, codes: np.ndarray, counts: np.ndarray, shards: int, length: int) -> Iterator[pa.RecordBatch]:
    """Rows for the shards of n-grams of a length; those of longer ones have higher numbers."""
    shard = ((codes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    asked, first = np.unique(shard, return_index=True)
    bounds = np.append(first, len(codes))
    gaps = np.diff(codes, prepend=np.uint64(0))
    gaps[first] = codes[first] - _first_code(asked, shards)
    yield from sliced(pa.RecordBatch.from_arrays(
        [pa.array(asked + shards * (length - 1), pa.int64()), pa.array(np.full(len(asked), block), pa.int64()),
         _binaries((gaps & np.uint64(0xFFFFFFFF)).astype(np.uint32), bounds),
         *_short((gaps >> np.uint64(32)).astype(np.int64), bounds, 0xFFFF, np.uint16), *_short(counts, bounds, 0xFF, np.uint8)],
        schema=_QUESTION), 16 << 20)


def _ask(shards: int):
    def work(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, t = key[0].as_py(), Tokens(batches)
        yield from _questions(block, t.words, t.word_counts, shards, 1)
        yield from _questions(block, t.pairs, t.pair_counts, shards, 2)

    return work


def _ask_again(shards: int):
    def work(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        t = Tokens(docs.to_batches())
        alone = Answers(t, answers).alone
        some = t.shared_triples(alone)
        asked = list(_questions(key[0].as_py(), t.triples[some], t.triple_counts[some], shards, 3))
        return pa.Table.from_batches(asked, _QUESTION)

    return work


def _answer(shards: int):
    def work(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        batches = list(batches)

        def every(name: str, kind) -> tuple[np.ndarray, np.ndarray]:
            parts = [_numbers(b.column(name), kind) for b in batches]
            return joined((p for p, _ in parts), kind), joined((n for _, n in parts), np.int64)

        low, sizes = every("low", np.uint32)
        high = _whole(every("high", np.uint16)[0], every("far", np.uint32)[0], 0xFFFF)
        summed = np.cumsum(low + (high.astype(np.uint64) << np.uint64(32)), dtype=np.uint64)
        starts = np.cumsum(sizes) - sizes
        before = np.where(starts > 0, summed[starts - 1], np.uint64(0))
        codes = summed - np.repeat(before, sizes) + _first_code(np.array(shard % shards), shards)
        counts = _whole(every("count", np.uint8)[0], every("many", np.uint32)[0], 0xFF)
        names, at = np.unique(codes, return_inverse=True)
        total = np.bincount(at, counts, len(names)).astype(np.int64)
        seen = np.where(names == BEGIN, 0, total)
        stats = [int(x) if shard < shards else 0 for x in (seen.sum(), (seen > 0).sum(), (seen == 1).sum(), (seen == 2).sum())]
        alone = np.bincount(at, minlength=len(names)) == 1
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        totals, many = _short(np.where(alone, 0, total)[at], bounds, 0x7F, np.uint8)
        flags = np.frombuffer(totals.buffers()[2], np.uint8) | np.where(alone[at], _ALONE, 0).astype(np.uint8)
        blocks = np.concatenate([b.column("block").to_numpy() for b in batches])
        out = pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(blocks), shard)), pa.array(blocks), _binaries(flags, bounds), many]
            # a shard's own figures come once
            + [pa.array([x] + [0] * (len(blocks) - 1), pa.int64()) for x in stats],
            names=["shard", "block", "total", "many", *_STATS])
        yield from sliced(out, 16 << 20)

    return work


class Answers:
    """The corpus counts of a block's words, pairs and triples; of triples only where all answers are there."""

    def __init__(self, t: Tokens, table: pa.Table):
        table = table.sort_by("shard")
        total, many = (_numbers(table.column(c), kind)[0] for c, kind in (("total", np.uint8), ("many", np.uint32)))
        alone, whole = total == _ALONE, _whole(total, many, 0x7F)
        parts = [len(t.words), len(t.words) + len(t.pairs)]
        (words, pairs, triples), own = np.split(whole, parts), np.split(alone, parts)
        self.words = np.where(own[0], t.word_counts, words)
        self.alone = own[1]
        self.pairs = np.where(own[1], t.pair_counts, pairs)
        self.triples = t.triple_counts.copy()
        if len(triples):
            some = np.flatnonzero(t.shared_triples(self.alone))
            self.triples[some] = np.where(own[2], self.triples[some], triples)


class Automaton:
    """The part of the automaton that a block's texts can reach."""

    def __init__(self, t: Tokens, counts: Answers, stats: dict[str, int], strengths: tuple[float, float]):
        n, v = stats["tokens"], stats["words"]
        one, two = strengths
        discount = stats["once"] / (stats["once"] + 2 * stats["twice"]) if stats["once"] else 0.5
        word = np.where(counts.words > 0, counts.words - discount, discount * v) / n if n else np.ones(len(counts.words))
        word = np.maximum(word, 1e-300)
        #: logarithms of the arcs' weights, and of the failure arcs by state; 0 where a context is no state
        self.word = np.log10(word)
        state, to = np.zeros(len(counts.pairs), np.int64), np.zeros(len(counts.pairs), np.int64)
        state[t.pair], to[t.pair] = t.state, t.word
        pair = (counts.pairs + one * word[to]) / (counts.words[state] + one)
        self.pair, self.pair_fails = np.log10(pair), np.log10(one / (counts.words + one))
        context, end = t.halves
        triple = (counts.triples + two * pair[end]) / (counts.pairs[context] + two)
        self.triple, self.triple_fails = np.log10(triple), np.log10(two / (counts.pairs + two))
        self.pair_seen, self.triple_seen = counts.pairs > 0, counts.triples > 0

    def read(self, t: Tokens) -> np.ndarray:
        """The weight of the arcs taken at each token: the state's own, or failure arcs and a shorter context's."""
        shorter = np.where(self.pair_seen[t.pair], self.pair[t.pair], self.pair_fails[t.state] + self.word[t.word])
        taken = shorter.copy()
        taken[t.inner] = np.where(self.triple_seen[t.triple], self.triple[t.triple],
                                  self.triple_fails[t.context] + shorter[t.inner])
        return taken


def _score(strengths: tuple[float, float]):
    def work(docs: pa.Table, answers: pa.Table) -> pa.Table:
        batches = docs.to_batches()
        t = Tokens(batches)
        counts = Answers(t, answers)
        stats = {name: answers.column(f"all_{name}")[0].as_py() for name in _STATS}
        seen = np.add.reduceat((counts.words > 0)[t.word], t.starts)
        base = np.log10((counts.words[t.word] + 1) / (stats["tokens"] + stats["words"] + 1))
        score = Automaton(t, counts, stats, strengths).read(t)
        new = dict(n_tokens=pa.array(t.sizes), n_known=pa.array(seen.astype(np.int64)),
                   train_tokens=pa.array(np.full(len(t.sizes), stats["tokens"])),
                   base_score=pa.array(np.add.reduceat(base, t.starts)), score=pa.array(np.add.reduceat(score, t.starts)))
        whole = docs.combine_chunks().to_batches()[0]
        return pa.Table.from_batches([with_columns(whole, drop=["__block", "__train", *new], **new)])

    return work


def score(docs: DataFrame, train: Column, strengths: tuple[float, float] = STRENGTHS, block: int = BLOCK) -> DataFrame:
    """`docs` with n_tokens, n_known (of training words), train_tokens, base_score and score (log10).

    `train` says which rows the model learns from; null counts as false. base_score is that
    of words with one added to each count.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block))
    dealt = docs.withColumns({"__train": train, "__block": F.pmod(F.xxhash64("text", "doc_id"), F.lit(blocks))})
    question = "shard long, block long, low binary, high binary, far binary, count binary, many binary"
    answer = "shard long, block long, total binary, many binary, " + ", ".join(f"{n} long" for n in _STATS)
    # the same columns as below, so that the texts are shuffled once
    asked = dealt.groupBy("__block").applyInArrow(_ask(blocks), question)
    answers = asked.groupBy("shard").applyInArrow(_answer(blocks), answer)
    again = dealt.groupBy("__block").cogroup(answers.groupBy("block")).applyInArrow(_ask_again(blocks), question)
    triples = again.groupBy("shard").applyInArrow(_answer(blocks), answer)
    stats = answers.agg(*[F.sum(n).alias(f"all_{n}") for n in _STATS])
    both = answers.unionByName(triples).select("shard", "block", "total", "many")
    both = both.crossJoin(F.broadcast(stats))  # one row of figures
    schema = schema_with(docs, n_tokens="long", n_known="long", train_tokens="long", base_score="double", score="double")
    return dealt.groupBy("__block").cogroup(both.groupBy("block")).applyInArrow(_score(strengths), schema)
