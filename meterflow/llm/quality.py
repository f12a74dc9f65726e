"""Quality scores of texts from a factorisation machine.

A text's features are its words, hashed into buckets, with the square roots of their
shares, and statistics of its structure and length. The machine adds to a linear
score an interaction of every pair of features, with the inner product of their
low-rank factors as weight; by the sum-of-squares identity, the sum over all pairs
takes time linear in the features: half of (sum v x)^2 - sum (v x)^2, over the ranks.

It is trained by Adam on a bounded sample of labelled texts, with as many of either
class, and the intercept is then moved to the classes' shares among all labels.
Null and empty texts have no words and get the score of their zero statistics. Texts
are scored whole; repeated rows get equal scores, and other columns pass through.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.labelled import fold, labelled_sample
from meterflow.llm.words import (NOT_ALNUM, SPACE, by_batch, joined, schema_with, text_bytes, with_columns, word_codes,
                                 word_spans)

#: Training documents of each class at most.
SAMPLE = 4_000
BUCKETS, RANK = 4096, 8
EPOCHS, BATCH, RATE, PENALTY, SEED = 12, 128, 0.01, 1e-4, 3
STATISTICS = ("log words", "log characters", "word length", "capitals", "digits", "signs", "other bytes",
              "distinct words", "most frequent word", "repeated neighbours", "lines", "distinct lines", "long words")
THRESHOLD = 0.5


def _share(n: np.ndarray, of: np.ndarray) -> np.ndarray:
    return n / np.maximum(of, 1)


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of `values` between bounds."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


class Features:
    """Features of a text column: statistics, and bucket numbers and values of the words of all texts."""

    def __init__(self, column: pa.Array):
        data, offsets = text_bytes(column)
        starts, ends, counts = word_spans(data, offsets, SPACE)
        n = len(counts)
        codes = word_codes(data, starts, ends)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        doc = np.repeat(np.arange(n), counts)
        # words of each text, with their numbers
        order = np.lexsort((codes, doc))
        c, d = codes[order], doc[order]
        first = np.ones(len(c), bool)
        first[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(first)
        times = np.diff(np.append(at, len(c)))
        own = d[at]
        most = np.zeros(n, np.int64)
        np.maximum.at(most, own, times)
        again = np.zeros(len(codes), bool)
        again[1:] = (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])
        # lines
        breaks = np.flatnonzero(data == 10)
        lines = 1 + np.diff(np.searchsorted(breaks, offsets))
        line_a = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
        line_b = np.sort(np.concatenate([breaks, offsets[1:]]))
        full = line_b > line_a
        line_doc = np.repeat(np.arange(n), lines)[full]
        line_codes = word_codes(data, line_a[full], line_b[full])
        different = np.unique(np.stack([line_doc.astype(np.uint64), line_codes]), axis=1)[0].astype(np.int64)
        size = np.diff(offsets)
        byte = lambda chosen: _share(_per_text(chosen, offsets), size)
        length = ends - starts
        self.statistics = np.stack([
            np.log1p(counts), np.log1p(size), _share(_per_text(length, bounds), counts) / 10,
            byte((data >= 65) & (data <= 90)), byte((data >= 48) & (data <= 57)),
            byte(NOT_ALNUM[data] & ~SPACE[data]), byte(data >= 128),
            _share(np.bincount(own, minlength=n), counts), _share(most, counts), _share(_per_text(again, bounds), counts),
            np.log1p(_share(lines, counts)), _share(np.bincount(different, minlength=n), np.bincount(line_doc, minlength=n)),
            _share(_per_text(length > 16, bounds), counts)], axis=1).astype(np.float64)
        # buckets
        key = own * BUCKETS + (c[at] % np.uint64(BUCKETS)).astype(np.int64)
        keys, where = np.unique(key, return_inverse=True)
        weight = np.bincount(where, times, len(keys))
        self.bucket = (keys % BUCKETS).astype(np.int32)
        self.sizes = np.bincount(keys // BUCKETS, minlength=n)
        self.value = np.sqrt(weight / np.maximum(np.repeat(counts, self.sizes), 1)).astype(np.float32)


class FactorisationMachine:
    def __init__(self, centre: np.ndarray, scale: np.ndarray, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.centre, self.scale = centre, scale
        size = len(STATISTICS) + BUCKETS
        self.bias, self.linear = 0.0, np.zeros(size)
        self.factors = random.normal(0, 0.05, (size, RANK))

    def rows(self, statistics: np.ndarray, bucket: np.ndarray, value: np.ndarray, sizes: np.ndarray):
        """All features in one sparse form: numbers, values, and the rows' bounds."""
        n, s = statistics.shape
        scaled = np.clip((statistics - self.centre) / self.scale, -4, 4) / np.sqrt(s)
        bounds = np.concatenate([[0], np.cumsum(sizes + s)])
        index, x = np.empty(bounds[-1], np.int64), np.empty(bounds[-1])
        head = (bounds[:-1, None] + np.arange(s)).ravel()
        tail = np.ones(bounds[-1], bool)
        tail[head] = False
        index[head], x[head] = np.tile(np.arange(s), n), scaled.ravel()
        index[tail], x[tail] = bucket + s, value
        return index, x, bounds

    def raw(self, index: np.ndarray, x: np.ndarray, bounds: np.ndarray):
        """The scores before the logistic curve, and the sums that the gradient needs."""
        parts = self.factors[index] * x[:, None]
        begin = bounds[:-1]
        sums = np.add.reduceat(parts, begin, axis=0)
        squares = np.add.reduceat((parts * parts).sum(1), begin)
        line = np.add.reduceat(self.linear[index] * x, begin)
        return self.bias + line + 0.5 * ((sums * sums).sum(1) - squares), sums, parts

    def __call__(self, features: Features) -> np.ndarray:
        if not len(features.sizes):
            return np.zeros(0)
        z, _, _ = self.raw(*self.rows(features.statistics, features.bucket, features.value, features.sizes))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def train(self, index: np.ndarray, x: np.ndarray, bounds: np.ndarray, y: np.ndarray, seed: int = SEED) -> None:
        random = np.random.default_rng(seed)
        state = [np.zeros_like(a) for a in (self.linear, self.linear, self.factors, self.factors)]
        bias, step = np.zeros(2), 0
        for _ in range(EPOCHS):
            order = random.permutation(len(y))
            for at in range(0, len(y), BATCH):
                chosen = order[at:at + BATCH]
                sizes = np.diff(bounds)[chosen]
                own = np.concatenate([[0], np.cumsum(sizes)])
                cells = np.repeat(bounds[chosen] - own[:-1], sizes) + np.arange(own[-1])
                i, v = index[cells], x[cells]
                z, sums, parts = self.raw(i, v, own)
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[chosen]) / len(chosen)
                pull = np.repeat(error, sizes) * v
                touched, to = np.unique(i, return_inverse=True)
                linear = np.bincount(to, pull, len(touched)) + PENALTY * self.linear[touched]
                slope = pull[:, None] * (np.repeat(sums, sizes, axis=0) - parts)
                factors = np.stack([np.bincount(to, slope[:, r], len(touched)) for r in range(RANK)], axis=1)
                factors += PENALTY * self.factors[touched]
                step += 1
                for value, gradient, m, s in ((self.linear, linear, state[0], state[1]),
                                              (self.factors, factors, state[2], state[3])):
                    m[touched] = 0.9 * m[touched] + 0.1 * gradient
                    s[touched] = 0.999 * s[touched] + 0.001 * gradient ** 2
                    value[touched] -= RATE * (m[touched] / (1 - 0.9 ** step)) / (
                        np.sqrt(s[touched] / (1 - 0.999 ** step)) + 1e-8)
                bias = np.array([0.9, 0.999]) * bias + np.array([0.1 * error.sum(), 0.001 * error.sum() ** 2])
                self.bias -= RATE * (bias[0] / (1 - 0.9 ** step)) / (np.sqrt(bias[1] / (1 - 0.999 ** step)) + 1e-8)


def _collected(rows: DataFrame) -> pa.Table:
    """Features of the sample, of bounded number, at the driver."""

    def work(batch):
        f = Features(batch.column("text"))
        ends = pa.array(np.concatenate([[0], np.cumsum(f.sizes)]), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array(np.arange(len(f.sizes) + 1) * f.statistics.shape[1], pa.int32()),
                                      pa.array(f.statistics.ravel())),
             pa.ListArray.from_arrays(ends, pa.array(f.bucket)), pa.ListArray.from_arrays(ends, pa.array(f.value)),
             batch.column("label")], names=["statistics", "bucket", "value", "label"])

    return rows.mapInArrow(by_batch(work), "statistics array<double>, bucket array<int>, value array<float>, label int").toArrow()


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine:
    """Learn from `labels.quality` of at most `sample` documents of each class.

    Only rows whose crc32(doc_id) modulo 3 is not 1 are used. Without any the score is 0.5.
    """
    keep = fold("doc_id", 3) != 1
    found = _collected(labelled_sample(docs, labels, "quality", keep, sample))
    n = found.num_rows
    flat = lambda name: joined((c.flatten().to_numpy() for c in found.column(name).chunks), float)
    statistics = flat("statistics").reshape(n, len(STATISTICS))
    scale = statistics.std(0) if n else np.ones(len(STATISTICS))
    machine = FactorisationMachine(statistics.mean(0) if n else np.zeros(len(STATISTICS)), np.where(scale > 0, scale, 1))
    if n:
        y = found.column("label").to_numpy().astype(float)
        sizes = joined((np.diff(c.offsets.to_numpy()) for c in found.column("bucket").chunks), np.int64)
        machine.train(*machine.rows(statistics, flat("bucket").astype(np.int64), flat("value"), sizes), y)
        everywhere = labels.where(keep & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
        odds = lambda p: np.log((p + 1e-3) / (1 - p + 1e-3))
        machine.bias += odds(everywhere) - odds(y.mean())
    return machine


def score(docs: DataFrame, model: FactorisationMachine, text: str = "text", into: str = "score") -> DataFrame:
    """`docs` with the quality of each whole text, from 0 to 1, in a column named by `into`; one of that name is replaced."""

    def work(batch):
        return with_columns(batch, drop=[into], **{into: pa.array(model(Features(batch.column(text))))})

    return docs.mapInArrow(by_batch(work), schema_with(docs, **{into: "double"}))
