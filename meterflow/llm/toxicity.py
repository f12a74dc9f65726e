"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Text is compressed as the 64-bit codes of its words, so that a match is a whole
word and shared syllables save nothing; the code of a long word is followed by that
of its beginning, since words of one stem have many endings. Each dictionary holds the words that are
typical of its class. A window of words that gets shorter with the toxic
dictionary than with the ordinary one speaks for toxicity; a logistic curve,
fitted on labelled texts that the dictionaries haven't seen, turns the windows'
savings into a score.

Null and empty texts have no windows and get the score of no saving. Texts are
scored whole, whatever their length. Repeated rows get equal scores, and other
columns of any name pass through.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.labelled import Logistic, fold, labelled_sample
from meterflow.llm.words import NOT_ALNUM, by_batch, schema_with, text_bytes, with_columns, word_codes, word_spans

#: Training documents of each class at most.
SAMPLE = 10_000
#: Codes in a window, and in a dictionary at most; bytes of a word's beginning.
WINDOW, DICTIONARY, STEM = 64, 4096, 5
#: A code enters a dictionary if so many of the class's documents have it, however many
#: documents there are, and it is so many times as frequent there as in the other.
LEAST, RATIO = 3, 30.0
THRESHOLD = 0.7
#: Bytes that compress to almost nothing, ahead of each window: without them the
#: library stores a window that would get only a few bytes shorter as it is.
_EASY = bytes(96)


def stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all texts, and the number of codes of each."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_spans(data, offsets, NOT_ALNUM)
    long = ends - starts > STEM
    place = np.arange(len(starts)) + np.concatenate([[0], np.cumsum(long)[:-1]]) if len(starts) else starts
    out = np.empty(len(starts) + long.sum(), np.uint64)
    out[place] = word_codes(data, starts, ends)
    out[place[long] + 1] = word_codes(data, starts[long], starts[long] + STEM)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    stems = np.concatenate([[0], np.cumsum(long)])
    return out, counts + stems[bounds[1:]] - stems[bounds[:-1]]


class Compressors:
    """One compressor for each dictionary, made where it is used."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        settings = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=15, hash_log=15, search_log=4, min_match=6, target_length=8,
            strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False,
            write_dict_id=False)
        self.toxic, self.ordinary = (self._made(words, settings) for words in (toxic, ordinary))

    @staticmethod
    def _made(words: bytes, settings):
        # a dictionary has eight bytes at least
        content = zstandard.ZstdCompressionDict(words or bytes(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(compression_params=settings)
        return zstandard.ZstdCompressor(dict_data=content, compression_params=settings)

    def savings(self, codes: np.ndarray) -> list[int]:
        """For each window, how many bytes the toxic dictionary saves over the ordinary one."""
        data, size = codes.tobytes(), WINDOW * 8
        short = self.toxic.compress, self.ordinary.compress
        return [len(short[1](window)) - len(short[0](window))
                for window in (_EASY + data[i:i + size] for i in range(0, len(data), size))]


def features(texts: pa.Array, compressors: Compressors) -> np.ndarray:
    """For each text: the largest saving, the log of their sum, and the saving for each word."""
    codes, counts = stream(texts)
    out = np.zeros((len(counts), 3))
    for i, own in enumerate(np.split(codes, np.cumsum(counts)[:-1]) if len(counts) else []):
        if len(own):
            saved = compressors.savings(own)
            out[i] = max(0, *saved) if len(saved) > 1 else max(0, saved[0]), np.log1p(
                sum(x for x in saved if x > 0)), sum(saved) / len(own)
    return out


class ToxicityModel:
    def __init__(self, toxic: bytes, ordinary: bytes, curve: Logistic):
        self.toxic, self.ordinary, self.curve = toxic, ordinary, curve

    def scorer(self):
        """A function from texts to scores; the compressors live as long as it does."""
        compressors = Compressors(self.toxic, self.ordinary)
        return lambda texts: self.curve(features(texts, compressors))


def _class_counts(rows: DataFrame) -> DataFrame:
    """(code, toxic, ordinary): in how many documents of each class each word is."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, counts = stream(batch.column("text"))
        label = np.repeat(batch.column("label").to_numpy(zero_copy_only=False), counts)
        doc = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        order = np.lexsort((doc, codes))
        codes, doc, label = codes[order], doc[order], label[order]
        first = np.ones(len(codes), bool)
        first[1:] = (codes[1:] != codes[:-1]) | (doc[1:] != doc[:-1])
        codes, label = codes[first], label[first]
        unique, at = np.unique(codes, return_inverse=True)
        n, hot = np.bincount(at, minlength=len(unique)), np.bincount(at, label, len(unique)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(unique.view(np.int64)), pa.array(hot), pa.array((n - hot).astype(np.int64))],
            names=["code", "toxic", "ordinary"])

    return (rows.mapInArrow(by_batch(work), "code long, toxic long, ordinary long")
            .groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


def _typical(counts: DataFrame, own: str, other: str, n_own: int, n_other: int) -> bytes:
    """The words typical of a class, the most frequent last, where matches cost least."""
    chosen = (counts.where((F.col(own) >= LEAST)
                           & (F.col(own) / F.lit(n_own + 1.0) > RATIO * (F.col(other) + 0.5) / F.lit(n_other + 1.0)))
              .orderBy(F.desc(own), "code").limit(DICTIONARY).select("code").collect())
    return np.array([r.code for r in reversed(chosen)], np.int64).tobytes()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
    """Learn from `labels.toxic` of at most `sample` documents of each class.

    Only rows whose crc32(doc_id) modulo 3 is not 1 are used. Three quarters of
    them, by a hash of the text, fill the dictionaries, and the rest fits the
    curve: equal texts never lie on both sides.
    """
    rows = labelled_sample(docs, labels, "toxic", fold("doc_id", 3) != 1, sample)
    held = F.pmod(F.xxhash64("text"), F.lit(4)) == 0
    learn, judge = rows.where(~held), rows.where(held)
    sizes = {r.label: r["count"] for r in learn.groupBy("label").count().collect()}
    counts = _class_counts(learn)
    n_toxic, n_ordinary = sizes.get(1, 0), sizes.get(0, 0)
    toxic = _typical(counts, "toxic", "ordinary", n_toxic, n_ordinary)
    ordinary = _typical(counts, "ordinary", "toxic", n_ordinary, n_toxic)

    def work():
        compressors = Compressors(toxic, ordinary)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = features(batch.column("text"), compressors)
            return pa.RecordBatch.from_arrays(
                [pa.array(found[:, i]) for i in range(3)] + [batch.column("label")],
                names=["a", "b", "c", "label"])

        return by_batch(one)

    found = (judge.mapInArrow(lambda batches: work()(batches), "a double, b double, c double, label int")
             .toPandas())
    return ToxicityModel(toxic, ordinary,
                         Logistic.fit(found[["a", "b", "c"]].to_numpy(float), found["label"].to_numpy(float)))


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", into: str = "score") -> DataFrame:
    """`docs` with the toxicity of each whole text, from 0 to 1, in a column named by `into`.

    A column of that name is replaced.
    """
    schema = schema_with(docs, **{into: "double"})

    def work(batches):
        scorer = model.scorer()

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            return with_columns(batch, drop=[into], **{into: pa.array(scorer(batch.column(text)))})

        yield from by_batch(one)(batches)

    return docs.mapInArrow(work, schema)


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with a score below the threshold, unchanged."""
    return score(docs, model, into="__toxicity").where(F.col("__toxicity") < threshold).drop("__toxicity")
