"""Drop lines that other documents hold already.

Two Bloom filters, of keys seen once and of keys seen at least twice, are built
from all lines. Only keys that the second filter holds, suspected repeats, are
shuffled: a group of each such key confirms or clears it by a 128-bit digest and
finds its first document. Documents without a suspected line are never shuffled.

A key is the line without white space at its ends, A-Z lowered; it counts if it
has `min_chars` code points or more. A key found in two documents or more stays
in the smallest doc_id only, there with all its lines. Rows with one doc_id are
one document. Rows with a null doc_id are one document too, the last of all.
Null and empty texts are one empty line. A document that loses all lines keeps
an empty text. Columns besides doc_id and text pass through.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.words import SPACE, by_batch, joined, mix, schema_with, text_bytes, with_columns, word_codes
from meterflow.storage import materialise

#: Filter bits for a line, and bits of a filter at most (64 MB). Past that bound
#: more lines are suspected and cleared again; the result is the same.
BITS_PER_LINE, MOST_BITS = 16, 1 << 29
#: Bits of a filter that one task merges; places of a key in a filter.
SLICE_BITS, PLACES = 1 << 20, 2
#: Places a task gathers before it hands them on.
_FLUSH = 1 << 19


class Lines:
    """The lines of a text column: spans of all, spans and codes of the keys that count."""

    def __init__(self, column: pa.Array, min_chars: int):
        self.data, offsets = text_bytes(column)
        breaks = np.flatnonzero(self.data == 10)
        docs = len(offsets) - 1
        self.starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
        self.ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
        self.count = 1 + np.diff(np.searchsorted(breaks, offsets))
        self.doc = np.repeat(np.arange(docs), self.count)
        solid = np.flatnonzero(~SPACE[self.data])
        low, high = np.searchsorted(solid, self.starts), np.searchsorted(solid, self.ends)
        full = np.flatnonzero(high > low)
        a, b = solid[low[full]], solid[high[full] - 1] + 1
        chars = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        enough = chars[b] - chars[a] >= min_chars
        #: which lines have a key that counts, and its span
        self.keyed, self.a, self.b = full[enough], a[enough], b[enough]
        self.codes = word_codes(self.data, self.a, self.b)

    def once_per_doc(self) -> np.ndarray:
        """Of the keyed lines, the first of each key in each document."""
        doc = self.doc[self.keyed]
        order = np.lexsort((self.codes, doc))
        c, d = self.codes[order], doc[order]
        first = np.ones(len(c), bool)
        first[1:] = (c[1:] != c[:-1]) | (d[1:] != d[:-1])
        return order[first]

    def digest(self, i: int) -> bytes:
        return hashlib.md5(self.data[self.a[i]:self.b[i]].tobytes().lower(), usedforsecurity=False).digest()


def places(codes: np.ndarray, bits: int) -> np.ndarray:
    """PLACES places of each code in a filter of `bits` (a power of two) bits."""
    step = mix(codes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) | np.uint64(1)
    return np.stack([(codes + step * np.uint64(i)) & np.uint64(bits - 1) for i in range(PLACES)])


def filter_bits(docs: DataFrame) -> int:
    """Bits of the filters for these texts: a power of two."""
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    n = docs.agg(F.sum(F.coalesce(lines, F.lit(1)))).first()[0] or 1
    return min(MOST_BITS, 1 << int(max(SLICE_BITS, n * BITS_PER_LINE) - 1).bit_length())


def seen_twice(docs: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The filter of keys seen twice, one bit for each place, packed into bytes."""

    def work(batches):
        held = []

        def flush():
            at, n = np.unique(joined(held, np.uint64), return_counts=True)
            held.clear()
            part = at // SLICE_BITS
            for s in np.unique(part):
                low, high = np.searchsorted(part, [s, s + np.uint64(1)])
                own = (at[low:high] - s * np.uint64(SLICE_BITS)).astype(np.uint32)
                yield int(s), own.tobytes(), own[n[low:high] > 1].tobytes()

        def out(rows):
            rows = list(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32())]
                + [pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)], names=["slice", "once", "twice"])

        for batch in batches:
            rows = max(1, int(batch.num_rows * (4 << 20) / max(batch.nbytes, 1)))
            for i in range(0, batch.num_rows, rows):
                lines = Lines(batch.column(0).slice(i, rows), min_chars)
                held.append(places(lines.codes[lines.once_per_doc()], bits).ravel())
                if sum(map(len, held)) >= _FLUSH:
                    yield out(flush())
        yield out(flush())

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(SLICE_BITS, bool), np.zeros(SLICE_BITS, bool)
        for batch in batches:
            for a, b in zip(batch.column("once"), batch.column("twice")):
                new = np.frombuffer(a.as_py(), np.uint32)
                twice[new[once[new]]] = True
                once[new] = True
                twice[np.frombuffer(b.as_py(), np.uint32)] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(twice).tobytes()], pa.binary())],
            names=["slice", "bits"])

    slices = (docs.select("text").mapInArrow(work, "slice int, once binary, twice binary")
              .groupBy("slice").applyInArrow(merge, "slice int, bits binary"))
    out = np.zeros(bits // 8, np.uint8)
    for row in slices.toLocalIterator():  # bits // 8 bytes in all, MOST_BITS // 8 at most
        at = row["slice"] * SLICE_BITS // 8
        out[at:at + SLICE_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def _suspected(lines: Lines, twice: np.ndarray, bits: int, which: np.ndarray) -> np.ndarray:
    """Of the keyed lines `which`, those whose places are all set."""
    at = places(lines.codes[which], bits)
    hit = (twice[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8)) & 1
    return which[hit.all(0)]


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """`docs` with the repeated lines gone from `text`, and their numbers in n_lines and n_dropped."""
    spark = docs.sparkSession
    bits = filter_bits(docs)
    twice = spark.sparkContext.broadcast(seen_twice(docs, bits, min_chars))

    def suspects(batch):
        lines = Lines(batch.column("text"), min_chars)
        found = _suspected(lines, twice.value, bits, lines.once_per_doc())
        ids = batch.column("doc_id").take(pa.array(lines.doc[lines.keyed[found]]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([lines.digest(i) for i in found], pa.binary())], names=["doc_id", "key"])

    schema = schema_with(docs.select("doc_id"), key="binary")
    suspected = materialise(docs.select("doc_id", "text").mapInArrow(by_batch(suspects), schema), "line-suspects")
    firsts = (suspected.groupBy("key")
              .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                   F.max(F.col("doc_id").isNull()).alias("nameless"))
              .where("first < last OR (nameless AND first IS NOT NULL)").select("key", "first"))
    firsts = materialise(firsts, "line-firsts")  # so that the join below can split a very common line
    drops = (suspected.join(firsts, "key").where(~F.col("doc_id").eqNullSafe(F.col("first")))
             .groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
             .select(F.col("doc_id").alias("__drop_id"), F.col("keys").alias("__drop_keys")))

    def mark(batch):
        lines = Lines(batch.column("text"), min_chars)
        doubtful = np.zeros(batch.num_rows, bool)
        doubtful[lines.doc[lines.keyed[_suspected(lines, twice.value, bits, np.arange(len(lines.codes)))]]] = True
        return with_columns(batch, n_lines=pa.array(lines.count, pa.int64()),
                            n_dropped=pa.array(np.zeros(batch.num_rows, np.int64)),
                            drop=("n_lines", "n_dropped", "__doubtful"), __doubtful=pa.array(doubtful))

    marked = docs.mapInArrow(by_batch(mark), schema_with(docs, n_lines="long", n_dropped="long", __doubtful="boolean"))
    plain = marked.where(~F.col("__doubtful")).drop("__doubtful")
    doubtful = marked.where("__doubtful").drop("__doubtful")
    doubtful = (doubtful.join(drops, doubtful["doc_id"].eqNullSafe(drops["__drop_id"]), "left").drop("__drop_id"))

    def cut(batch):
        text, dropped = batch.column("text"), batch.column("n_dropped").to_numpy(zero_copy_only=False).copy()
        lists = batch.column("__drop_keys")
        rows = np.flatnonzero(np.asarray(lists.is_valid()))
        if len(rows):
            lines = Lines(text.take(pa.array(rows)), min_chars)
            new = text.to_pylist()
            ends = np.cumsum(lines.count)
            for row, begin, end in zip(rows, ends - lines.count, ends):
                keys = set(lists[int(row)].as_py())
                keyed = range(*np.searchsorted(lines.keyed, [begin, end]))
                gone = {int(lines.keyed[i]) for i in keyed if lines.digest(i) in keys}
                dropped[row] = len(gone)
                new[row] = b"\n".join(lines.data[lines.starts[j]:lines.ends[j]].tobytes()
                                      for j in range(begin, end) if j not in gone).decode()
            text = pa.array(new, text.type)
        columns = [text if n == "text" else pa.array(dropped) if n == "n_dropped" else batch.column(i)
                   for i, n in enumerate(batch.schema.names)]
        keep = [i for i, n in enumerate(batch.schema.names) if n != "__drop_keys"]
        return pa.RecordBatch.from_arrays([columns[i] for i in keep], names=[batch.schema.names[i] for i in keep])

    return plain.unionByName(doubtful.mapInArrow(by_batch(cut), plain.schema))



def without_repeats(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """`docs` in its own columns, without the repeated lines; a column n_chars follows the text."""
    out = dedup_lines(docs, min_chars)
    changed = F.col("n_dropped") > 0
    return out.select(*[
        F.when(changed, F.length("text").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
        if f.name == "n_chars" else F.col(f.name) for f in docs.schema.fields])
