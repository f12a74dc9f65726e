"""Words of whole Arrow text columns as 64-bit codes, without a Python loop over words.

A code depends on the word alone, so it is the same in every process and run.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, StructType

_UPPER = np.arange(65, 91)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Characters whose running hash is held at once (a longer word still fits).
_WINDOW = 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit codes (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


mix = _mixed

#: One random code per byte; A-Z have those of a-z.
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BYTE[_UPPER] = _BYTE[_UPPER + 32]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def separators(alnum: bool = False) -> np.ndarray:
    """Which bytes end a word: white space (0x20, 0x09-0x0D), or all ASCII but letters and digits."""
    table = np.zeros(256, bool)
    if alnum:
        table[:128] = True
        table[48:58] = table[65:91] = table[97:123] = False
    else:
        table[[9, 10, 11, 12, 13, 32]] = True
    return table


SPACE, NOT_ALNUM = separators(), separators(alnum=True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and the n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray):
    """Starts and ends (in bytes) of all words, and how many each text has. No word spans two texts."""
    inside = np.zeros(len(data) + 1, bool)
    np.logical_not(ends_word[data], out=inside[:-1])
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[begins] = inside[begins]
    last = inside[:-1] & ~inside[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of the words data[starts:ends], A-Z counting as a-z."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    powers = inverses = np.ones(1, np.uint64)
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + _WINDOW, "right")))
        n = int(ends[to - 1] - low)
        if n > len(powers):
            size = max(n, _WINDOW)
            powers = np.cumprod(np.full(size, _BASE))
            inverses = np.cumprod(np.full(size, _INVERSE))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data[low:low + n]] * powers[:n], out=total[1:])
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = _mixed((total[b] - total[a]) * inverses[a] + (b - a).astype(np.uint64) * _ODD)
        at = to
    return out


def codes_of(column: pa.Array, ends_word: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words of a text column, and the number of words of each text."""
    data, offsets = text_bytes(column)
    starts, ends, counts = word_spans(data, offsets, ends_word)
    return word_codes(data, starts, ends), counts


def joined(parts: Iterable[np.ndarray], dtype) -> np.ndarray:
    parts = list(parts)
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def by_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], most_bytes: int = 4 << 20):
    """`work` for mapInArrow, fed slices of whole rows that hold about `most_bytes` at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in sliced(batch, most_bytes):
                if (out := work(piece)) is not None:
                    yield out

    return run


def sliced(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces; a single row larger than the limit makes a piece of its own."""
    rows = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def with_columns(batch: pa.RecordBatch, drop: Iterable[str] = (), **new: pa.Array) -> pa.RecordBatch:
    """The batch without some columns (in any case of letters) and with new ones at its end."""
    gone = {n.lower() for n in drop}
    keep = [i for i, n in enumerate(batch.schema.names) if n.lower() not in gone]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + list(new.values()),
                                      names=[batch.schema.names[i] for i in keep] + list(new))


def schema_with(df: DataFrame, **new: str) -> StructType:
    """The columns of `df` but those named in `new` (in any case of letters), then `new`: name=type."""
    gone = {n.lower() for n in new}
    out = StructType([f for f in df.schema.fields if f.name.lower() not in gone])
    for name, kind in new.items():
        out = out.add(name, DataType.fromDDL(kind))
    return out
