"""Benchmark items too many for broadcast automata: dealt into shards, which runs of the texts are sent to.

1. Items become pieces of PIECE windows, each with all words of its windows, so that
   no window is cut. Pieces are dealt by hash into shards of one automaton each.
2. A Bloom filter of the items' windows goes to every task. Where a text has windows
   that the filter holds, the words they cover are a run. Texts without runs are done;
   they are never shuffled.
3. Different runs are looked up by window in the table of the items' windows, which
   names the shards that hold them. The automata of these shards match the runs; a
   shard with many runs is built in several tasks, each with a share of the runs.
4. What was found goes back to the texts by the runs' and the texts' digests.

Beyond MOST_BITS the filter fills up and more runs are looked up in vain; the result
is the same.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.words import NOT_ALNUM, by_batch, codes_of, joined, mix, schema_with, sliced, with_columns
from meterflow.storage import materialise

#: Windows of an item in a piece at most.
PIECE = 20_000
#: Filter bits for a window, places of a window in the filter, and bits at most (64 MB).
BITS_PER_WINDOW, PLACES, MOST_BITS = 32, 6, 1 << 29
#: Words of runs that a task matches, about.
RUN_WORDS = 2_000_000
_PART = 1 << 15


def window_codes(words: np.ndarray, size: int) -> np.ndarray:
    """Codes of all runs of `size` words, by their first word."""
    grams = np.full(max(0, len(words) - size + 1), size, np.uint64)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    for i in range(size):
        grams += words[i:i + len(grams)] * factors[i]
    return mix(grams)


def places(codes: np.ndarray, bits: int) -> np.ndarray:
    """PLACES places of each code in a filter of `bits` (a power of two) bits."""
    step = mix(codes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) | np.uint64(1)
    return np.stack([(codes + step * np.uint64(i)) & np.uint64(bits - 1) for i in range(PLACES)])


def _words(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_py(), np.uint64)


def pieces_of(items: DataFrame, window: int, parts: int) -> DataFrame:
    """(item_id, words, n, shard): the items' words in pieces; items without words have none."""

    def work(batch):
        codes, counts = codes_of(batch.column("text"), NOT_ALNUM)
        names, pieces = [], []
        for name, n, end in zip(batch.column("item_id").to_pylist(), counts, np.cumsum(counts)):
            for at in range(end - n, max(end - n + 1, end - window + 1) if n else end - n, PIECE):
                names.append(name)
                pieces.append(codes[at:min(end, at + PIECE + window - 1)])
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([p.tobytes() for p in pieces], pa.binary()),
             pa.array([len(p) for p in pieces], pa.int64())], names=["item_id", "words", "n"])

    pieces = items.mapInArrow(by_batch(work), "item_id string, words binary, n long").distinct()
    return pieces.withColumn("shard", F.pmod(F.xxhash64("words"), F.lit(parts)))


def windows_of(pieces: DataFrame, window: int) -> DataFrame:
    """(code, shard): the windows of the pieces."""

    def work(batches):
        for batch in batches:
            for words, shard in zip(batch.column("words"), batch.column("shard").to_pylist()):
                words = _words(words)
                codes = np.unique(window_codes(words, min(window, len(words))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes.view(np.int64)), pa.array(np.full(len(codes), shard))], names=["code", "shard"])

    return pieces.select("words", "shard").mapInArrow(work, "code long, shard long").distinct()


class WindowFilter:
    """A Bloom filter of the items' windows, and the sizes that these have."""

    def __init__(self, windows: DataFrame, sizes: list[int]):
        self.sizes, n = sizes, windows.count()
        self.bits = bits = min(MOST_BITS, 1 << (max(_PART, n * BITS_PER_WINDOW) - 1).bit_length())

        def work(batch):
            at = places(batch.column("code").to_numpy().view(np.uint64), bits).ravel().astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(at)], names=["at"])

        parts = (windows.select("code").mapInArrow(by_batch(work), "at long")
                 .groupBy(F.expr(f"at div {_PART}").alias("part"))
                 .agg(F.expr(f"bitmap_construct_agg(at % {_PART})").alias("set")))
        self.set = np.zeros(bits // 8, np.uint8)
        for row in parts.toLocalIterator():  # 4 KB each, bits // 8 bytes in all
            self.set[row["part"] * _PART // 8:(row["part"] + 1) * _PART // 8] = np.frombuffer(row["set"], np.uint8)

    def runs(self, codes: np.ndarray, counts: np.ndarray):
        """Text, first word and end of each stretch of words that windows in the filter cover."""
        bounds = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(counts)), counts)
        depth = np.zeros(len(codes) + 1, np.int64)
        for size in self.sizes:
            at = places(window_codes(codes, size), self.bits)
            hit = ((self.set[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(0)
            begin = np.flatnonzero(hit)
            begin = begin[text[begin] == text[begin + size - 1]]
            depth[begin] += 1
            np.subtract.at(depth, begin + size, 1)
        covered = np.cumsum(depth[:-1]) > 0
        first, last = covered.copy(), covered.copy()
        same = text[1:] == text[:-1]
        first[1:] &= ~(covered[:-1] & same)
        last[:-1] &= ~(covered[1:] & same)
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return text[begin], begin - bounds[text[begin]], begin, end


def find_in_shards(docs: DataFrame, items: DataFrame, window: int, parts: int, index_of, merged) -> DataFrame:
    """`docs` with n_words, n_hit, hits and items, as `decontaminate.find_matches` gives them.

    `items` has item_id and text, no nulls. `index_of(names, sequences, window)` makes an
    automaton's index over word codes; `merged` joins spans.
    """
    spark = docs.sparkSession
    pieces = materialise(pieces_of(items, window, parts), "item-pieces")
    windows = materialise(windows_of(pieces, window), "item-windows")
    sizes = sorted(r[0] for r in pieces.select(F.least("n", F.lit(window))).distinct().collect())  # `window` at most
    shared = spark.sparkContext.broadcast(WindowFilter(windows, sizes).__dict__)

    def runs_in(column):
        held = WindowFilter.__new__(WindowFilter)
        held.__dict__.update(shared.value)
        codes, counts = codes_of(column, NOT_ALNUM)
        return codes, counts, *held.runs(codes, counts)

    def digests(column, which):
        return [hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in column.take(pa.array(which)).to_pylist()]

    def mark(batch):
        _, counts, text, *_ = runs_in(batch.column("text"))
        which = np.unique(text)
        names = np.full(batch.num_rows, None, object)
        names[which] = digests(batch.column("text"), which)
        n = batch.num_rows
        return with_columns(
            batch, drop=("n_words", "n_hit", "hits", "items", "__text"), n_words=pa.array(counts, pa.int64()),
            n_hit=pa.array(np.zeros(n, np.int64)), hits=pa.array([[]] * n, pa.list_(pa.int64())),
            items=pa.array([[]] * n, pa.list_(pa.string())), __text=pa.array(names, pa.binary()))

    def cut(batch):
        codes, _, text, at, begin, end = runs_in(batch.column("text"))
        which, place = np.unique(text, return_inverse=True)
        words = [codes[b:e].tobytes() for b, e in zip(begin, end)]
        return pa.RecordBatch.from_arrays(
            [pa.array(digests(batch.column("text"), which), pa.binary()).take(pa.array(place)), pa.array(at, pa.int64()),
             pa.array([hashlib.md5(w, usedforsecurity=False).digest() for w in words], pa.binary()),
             pa.array(words, pa.binary())], names=["text", "at", "run", "words"])

    def ask(batches):
        for batch in batches:
            for run, words in zip(batch.column("run").to_pylist(), batch.column("words")):
                words = _words(words)
                codes = np.unique(joined([window_codes(words, s) for s in sizes], np.uint64)).view(np.int64)
                yield from sliced(pa.RecordBatch.from_arrays(
                    [pa.array([run] * len(codes), pa.binary()), pa.array(codes)], names=["run", "code"]), 4 << 20)

    found = materialise(docs.select("text").mapInArrow(by_batch(cut), "text binary, at long, run binary, words binary"),
                        "text-runs")
    runs = materialise(found.select("run", "words").distinct(), "runs")
    asked = runs.mapInArrow(ask, "run binary, code long").join(windows, "code").select("run", "shard").distinct()
    sent = materialise(runs.join(asked, "run"), "runs-for-shards")
    tasks = sent.groupBy("shard").agg(F.ceil(F.sum(F.length("words")) / F.lit(8 * RUN_WORDS)).cast("int").alias("tasks"))
    sent = sent.join(tasks, "shard").withColumn("task", F.pmod(F.xxhash64("run"), F.col("tasks")).cast("int"))
    built = (pieces.join(tasks, "shard")
             .withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))))

    def match(key, items, runs):
        index = index_of(items.column("item_id").to_pylist(), [_words(w) for w in items.column("words")], window)
        words = [_words(w) for w in runs.column("words")]
        _, spans, names = index.match_codes(joined(words, np.uint64), np.array([len(w) for w in words], np.int64))
        return pa.table([runs.column("run").cast(pa.binary()),
                         pa.array([[x for s in own for x in s] for own in spans], pa.list_(pa.int64())),
                         pa.array([sorted(n) for n in names], pa.list_(pa.string()))], names=["run", "hits", "items"])

    by = ("shard", "task")
    matched = (built.select(*by, "item_id", "words").groupBy(*by)
               .cogroup(sent.select(*by, "run", "words").groupBy(*by))
               .applyInArrow(match, "run binary, hits array<long>, items array<string>"))
    matched = materialise(matched.where("size(hits) > 0"), "runs-matched")
    of_text = materialise(
        found.select("text", "at", "run").distinct().join(matched, "run")
        .groupBy("text").agg(F.collect_list(F.struct("at", "hits", "items")).alias("__found")), "texts-matched")
    of_text = of_text.withColumnRenamed("text", "__matched")

    schema = schema_with(docs, n_words="long", n_hit="long", hits="array<long>", items="array<string>")
    marked = docs.mapInArrow(by_batch(mark), schema_with(
        docs, n_words="long", n_hit="long", hits="array<long>", items="array<string>", __text="binary"))

    def fill(batch):
        hits, names = [], []
        for parts_ in batch.column("__found").to_pylist():
            spans, ids = [], set()
            for p in parts_ or ():
                spans += [(p["at"] + b, p["at"] + e) for b, e in zip(p["hits"][::2], p["hits"][1::2])]
                ids |= set(p["items"])
            hits.append(merged(spans))
            names.append(sorted(ids))
        return with_columns(
            batch, drop=("n_words", "n_hit", "hits", "items", "__found"), n_words=batch.column("n_words"),
            n_hit=pa.array([sum(e - b for b, e in s) for s in hits], pa.int64()),
            hits=pa.array([[x for s in own for x in s] for own in hits], pa.list_(pa.int64())),
            items=pa.array(names, pa.list_(pa.string())))

    doubtful = (marked.where("__text IS NOT NULL").join(of_text, F.col("__text") == F.col("__matched"), "left")
                .drop("__text", "__matched"))
    return (marked.where("__text IS NULL").drop("__text")
            .unionByName(doubtful.mapInArrow(by_batch(fill), schema)))
