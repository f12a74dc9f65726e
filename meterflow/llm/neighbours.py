"""Nearest neighbours by cosine, with randomly rotated one-bit codes.

Every vector is scaled to length 1, rotated by one random rotation, and kept as
the signs of its components, packed into bits, with one correction scalar: the
inner product of the rotated vector and its code. A rotated query is rounded to whole
steps and kept as bit planes; counting the bits that a code and each plane share gives
the inner product of code and query. With the scalar it is an estimate without bias, with an error
bound that holds for nearly all pairs; what the rounding can change is added to it. A task estimates all of its rows, scores those with the best
estimates exactly, and then every row whose upper bound reaches the k-th best score
so far; so the bound, not a cap, decides how many vectors are scored.

Queries go to all tasks in blocks of bounded size, and a task returns its k best
rows for each query, so what is shuffled doesn't depend on the vectors' number.
Vectors that are null, zero, hold null or non-finite components, or have another
length than most, take no part, and neither do rows without an id. Rows with the
query's id are its own. An id that is repeated is found once, with its best score; a
query that is repeated asks once, with the smallest of its vectors. Ties go to the
smaller id. Empty tables give no rows.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.shared import Shared
from meterflow.storage import materialise

SEED = 7
#: How many deviations wide the error bounds are; wider finds more of the rare misses.
WIDTH = 1.9
#: Queries that are sent to the tasks at once, and rows that a task estimates at once.
QUERY_BLOCK, ROW_BLOCK = 4096, 16_384
#: Bits that a component of a rotated query is rounded to.
QUERY_BITS = 8


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation of `dim` dimensions, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and the inner product of each with its code."""
    turned = unit(vectors) @ turn.T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / np.sqrt(vectors.shape[1])


def as_words(codes: np.ndarray) -> np.ndarray:
    """Packed codes as rows of 64-bit words, filled up with unset bits."""
    out = np.zeros((len(codes), -(-codes.shape[1] // 8) * 8), np.uint8)
    out[:, :codes.shape[1]] = codes
    return out.view(np.uint64)


def planes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit queries in whole steps: (bit planes of the steps, lowest value, size of a step) of each."""
    low = turned.min(1)
    step = np.maximum((turned.max(1) - low) / ((1 << QUERY_BITS) - 1), 1e-12)
    levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    bits = np.stack([as_words(np.packbits(levels >> j & 1, axis=1)) for j in range(QUERY_BITS)], axis=1)
    return bits, low, step


class Estimator:
    """Inner products of coded rows with queries, estimated from packed bits by counting them."""

    def __init__(self, codes: np.ndarray, scalars: np.ndarray, dim: int):
        self.words, self.dim = as_words(codes), dim
        self.ones = np.bitwise_count(self.words).sum(1, dtype=np.int64)
        self.scale = 1 / (np.sqrt(dim) * scalars)
        self.bound = WIDTH * np.sqrt(np.maximum(0, 1 - scalars ** 2)) / scalars / np.sqrt(max(1, dim - 1)) + 1e-5
        #: what rounding a query by half a step in each component can change at most
        self.rounding = dim * self.scale / 2

    def __call__(self, bits: np.ndarray, low: float, step: float) -> tuple[np.ndarray, np.ndarray]:
        """For one query of `planes`: each row's estimate and error bound."""
        steps = np.zeros(len(self.words), np.int64)
        for j, plane in enumerate(bits):
            steps += np.bitwise_count(self.words & plane).sum(1, dtype=np.int64) << j
        total = self.dim * low + step * self._levels(bits)
        return (2 * (low * self.ones + step * steps) - total) * self.scale, self.bound + self.rounding * step

    @staticmethod
    def _levels(bits: np.ndarray) -> int:
        """The sum of a query's steps."""
        return sum(int(np.bitwise_count(plane).sum()) << j for j, plane in enumerate(bits))


def usable(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and vectors of those that take part."""
    rows = [i for i, n in enumerate(pc.list_value_length(column).to_pylist()) if n == dim]
    flat = column.take(pa.array(rows, pa.int64())).flatten()
    values = np.asarray(flat.cast(pa.float64()).fill_null(np.nan)).reshape(len(rows), dim)
    good = np.isfinite(values).all(1) & (values != 0).any(1)
    return np.array(rows, np.int64)[good], values[good]


def build_index(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, embedding, code, scalar) of every vector that takes part, and the dimension."""
    vectors = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    common = (vectors.groupBy(F.size("embedding").alias("dim")).count().where("dim > 0")
              .orderBy(F.desc("count"), "dim").first())
    dim = common["dim"] if common else 1
    turn = rotation(dim)

    def work(batches):
        for batch in batches:
            rows, values = usable(batch.column("embedding"), dim)
            codes, scalars = encode(values, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)),
                 pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), dim).cast(pa.list_(pa.float64())),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scalars)],
                names=["vec_id", "embedding", "code", "scalar"])

    index = vectors.mapInArrow(work, "vec_id long, embedding array<double>, code binary, scalar double")
    return materialise(index, "vector-index"), dim


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


class Queries:
    """A block of queries, searched for in blocks of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.planes = planes(unit(vectors) @ rotation(vectors.shape[1]).T) if len(ids) else ()
        self.found = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)

    def _scored(self, q: int, values: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return (values * self.vectors[q]).sum(1) / (norms * self.norms[q])

    def search(self, ids: np.ndarray, values: np.ndarray, codes: np.ndarray, scalars: np.ndarray) -> None:
        k = self.k
        # of equal vectors, the k + 1 smallest ids are all that any query can need
        order = np.lexsort((ids, *values.T[::-1]))
        same = np.zeros(len(ids), bool)
        same[1:] = (values[order][1:] == values[order][:-1]).all(1)
        start = np.maximum.accumulate(np.where(same, 0, np.arange(len(ids))))
        keep = np.sort(order[np.arange(len(ids)) - start <= k])
        ids, values, codes, scalars = ids[keep], values[keep], codes[keep], scalars[keep]
        norms = np.sqrt((values * values).sum(1))
        near = Estimator(codes, scalars, values.shape[1])
        for q, (own, *asked) in enumerate(zip(self.ids, *self.planes)):
            guess, bound = near(*asked)
            other = ids != own
            first = np.argpartition(-guess, min(8 * k, len(ids) - 1))[:8 * k]
            first = first[other[first]]
            held, names = self.found[q]
            sure = np.concatenate([held, self._scored(q, values[first], norms[first])])
            least = np.partition(sure, -k)[-k] if len(sure) >= k else -np.inf
            able = np.flatnonzero((guess + bound >= least) & other)
            scores = np.concatenate([held, self._scored(q, values[able], norms[able])])
            names = np.concatenate([names, ids[able]])
            scores, names = _once(scores, names)
            best = _best(scores, names, k)
            self.found[q] = scores[best], names[best]

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s, _ in self.found]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(self.ids, sizes)),
             pa.array(np.concatenate([n for _, n in self.found] or [np.zeros(0, np.int64)])),
             pa.array(np.concatenate([s for s, _ in self.found] or [np.zeros(0)]))],
            names=["query_id", "vec_id", "score"])


def _once(scores: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id once, with its best score."""
    order = np.lexsort((-scores, names))
    scores, names = scores[order], names[order]
    first = np.ones(len(names), bool)
    first[1:] = names[1:] != names[:-1]
    return scores[first], names[first]


def search(index: DataFrame, dim: int, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): of each task the k best rows for each query, and more."""
    spark = index.sparkSession
    asked = materialise(queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    parts = []
    for b in range(blocks):  # a block's size is bounded, whatever the number of queries
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()
        block = Shared(spark, (np.array([r.vec_id for r in rows], np.int64),
                               np.array([r.embedding for r in rows], float).reshape(len(rows), dim)))

        def work(batches, block=block):
            ask = Queries(*block.value, k)
            for batch in batches:
                for at in range(0, batch.num_rows, ROW_BLOCK):
                    piece = batch.slice(at, ROW_BLOCK)
                    values = np.asarray(piece.column("embedding").flatten()).reshape(piece.num_rows, dim)
                    codes = np.frombuffer(b"".join(piece.column("code").to_pylist()), np.uint8)
                    ask.search(piece.column("vec_id").to_numpy(), values, codes.reshape(piece.num_rows, -1),
                               piece.column("scalar").to_numpy())
            yield ask.rows()

        parts.append(materialise(index.mapInArrow(work, "query_id long, vec_id long, score double"), "found"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def nearest(vectors: DataFrame, is_query, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each row that `is_query` chooses, by cosine."""
    index, dim = build_index(vectors)
    found = search(index, dim, index.where(is_query).select("vec_id", "embedding"), k)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
