"""Fill-in-the-middle forms of documents, made with a piece table.

The bytes of a batch of texts are one buffer that is never changed, the sentinels
another. A document is a row of descriptors, each a stretch (buffer, start, end):

- cutting replaces a descriptor by the three that meet at the cuts,
- arranging permutes the descriptors, the sentinels' among them,
- restoring finds the sentinels in an arranged text, applies the inverse permutation
  and leaves the sentinels out,
- hashes are fed the stretches one after the other; no text is put together for them.

A text is cut between units, `[A-Za-z]+|[^A-Za-z]`: the prefix ends after the smaller of
h1 % (n + 1) and h2 % (n + 1) units, the middle after the larger. h1 to h4 are the first
four 8-digit groups of the hex SHA-256 of `<seed>:<key>`. The form is plain if the text is
empty or holds a sentinel, or if h3 % 100 >= `rate`; otherwise spm if h4 % 100 < `spm`,
else psm:

    plain  the text
    psm    <P> prefix <S> suffix <M> middle
    spm    <S> suffix <P> prefix <M> middle

A text without sentinels gets each of them once, and none can arise where stretches meet,
so every form can be read back exactly. Null texts count as empty ones, a null key as an
empty one. Repeated rows come out repeated, with equal cuts. Other columns pass through;
those named like a new one are replaced. Rows are worked on where they are read, in pieces
of about 4 MB (a longer text makes one of its own): nothing is shuffled.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.words import by_batch, schema_with, text_bytes, with_columns

#: Percent of the texts that are cut, and of these that are in the order suffix, prefix, middle.
RATE, SPM = 90, 20
SENTINELS = ("<P>", "<S>", "<M>")
#: Descriptors of a cut document: the three sentinels, then its own parts.
_P, _S, _M, _PREFIX, _MIDDLE, _SUFFIX = range(6)
#: Which descriptor stands in each place. Plain forms have empty sentinels.
ARRANGEMENTS = {
    "plain": (_P, _S, _M, _PREFIX, _MIDDLE, _SUFFIX),
    "psm": (_P, _PREFIX, _S, _SUFFIX, _M, _MIDDLE),
    "spm": (_S, _SUFFIX, _P, _PREFIX, _M, _MIDDLE),
}
FORMS = tuple(ARRANGEMENTS)
_ORDERS = np.array([ARRANGEMENTS[f] for f in FORMS])

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class PieceTable:
    """Documents as rows of descriptors over the texts' bytes and the sentinels."""

    def __init__(self, column: pa.Array):
        self.text, self.offsets = text_bytes(column)
        self.buffers = (self.text, np.frombuffer("".join(SENTINELS).encode(), np.uint8))
        #: of each document, the descriptors' buffers, starts and ends
        self.buffer = np.zeros((len(self), 1), np.int64)
        self.start, self.end = self.offsets[:-1, None], self.offsets[1:, None]

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def unit_starts(self) -> np.ndarray:
        """Byte positions at which the units of all texts begin."""
        letter = _LETTER[self.text]
        begins = (self.text & 0xC0) != 0x80
        begins[1:] &= ~(letter[1:] & letter[:-1])
        heads = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        begins[heads] = True
        return np.flatnonzero(begins)

    def sentinel_at(self) -> np.ndarray:
        """Of each document, where each sentinel is (the first of them); -1 if nowhere."""
        found = np.full((len(self), 3), -1, np.int64)
        opens = np.flatnonzero(self.text[:-2] == ord("<")) if len(self.text) > 2 else np.zeros(0, np.int64)
        opens = opens[self.text[opens + 2] == ord(">")]
        doc = np.searchsorted(self.offsets, opens, "right") - 1
        inside = opens + 3 <= self.offsets[doc + 1]
        opens, doc = opens[inside], doc[inside]
        for k, name in enumerate(SENTINELS):
            at = np.flatnonzero(self.text[opens + 1] == ord(name[1]))[::-1]
            found[doc[at], k] = opens[at]
        return found

    def cut(self, first: np.ndarray, second: np.ndarray) -> None:
        """Split each document's one descriptor at two positions of its buffer."""
        bounds = np.column_stack([self.start, first, second, self.end])
        self.buffer = np.repeat(self.buffer, 3, axis=1)
        self.start, self.end = bounds[:, :-1], bounds[:, 1:]

    def add_sentinels(self, wanted: np.ndarray) -> None:
        """Put the sentinels' descriptors before the others, empty where they aren't wanted."""
        starts = np.broadcast_to(np.array([0, 3, 6]), (len(self), 3))
        self.buffer = np.hstack([np.ones((len(self), 3), np.int64), self.buffer])
        self.start = np.hstack([starts, self.start])
        self.end = np.hstack([starts + 3 * wanted[:, None], self.end])

    def permute(self, order: np.ndarray) -> None:
        """Put descriptor order[d, i] of each document d in its place i."""
        self.buffer, self.start, self.end = (np.take_along_axis(x, order, 1) for x in (self.buffer, self.start, self.end))

    def pieces(self, doc: int) -> Iterator[np.ndarray]:
        for b, s, e in zip(self.buffer[doc].tolist(), self.start[doc].tolist(), self.end[doc].tolist()):
            if s < e:
                yield self.buffers[b][s:e]

    def sha256(self) -> pa.Array:
        out = []
        for doc in range(len(self)):
            digest = hashlib.sha256()
            for piece in self.pieces(doc):
                digest.update(piece)
            out.append(digest.hexdigest())
        return pa.array(out, pa.string())

    def texts(self, whole: np.ndarray | None = None) -> pa.Array:
        """The texts that the descriptors stand for; null where `whole` is false."""
        parts = [p for doc in range(len(self)) for p in self.pieces(doc)]
        data = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        offsets = np.concatenate([[0], np.cumsum((self.end - self.start).sum(axis=1))]).astype(np.int64)
        binary = pa.Array.from_buffers(pa.large_string(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        if whole is not None:
            binary = pc.if_else(pa.array(whole), binary, None)
        return binary.cast(pa.string())


def _arranged(rate: int, spm: int, text: bool):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = PieceTable(batch.column("text"))
        h1, h2, h3, h4 = (batch.column(f"__h{i}").to_numpy() for i in range(1, 5))
        begins = table.unit_starts()
        first = np.searchsorted(begins, table.offsets)
        n = np.diff(first)
        cuts = np.sort(np.column_stack([h1 % (n + 1), h2 % (n + 1)]), axis=1)
        # the position after the last unit of a text is where the next text begins
        at = np.append(begins, len(table.text))[first[:-1, None] + cuts]
        at = np.where(cuts == n[:, None], table.offsets[1:, None], at)
        plain = (n == 0) | (table.sentinel_at() >= 0).any(axis=1) | (h3 % 100 >= rate)
        form = np.where(plain, FORMS.index("plain"), np.where(h4 % 100 < spm, FORMS.index("spm"), FORMS.index("psm")))
        points = np.concatenate([[0], np.cumsum((table.text & 0xC0) != 0x80)])
        chars = points[at] - points[table.offsets[:-1, None]]
        table.cut(at[:, 0], at[:, 1])
        table.add_sentinels(~plain)
        table.permute(_ORDERS[form])
        new = {"n": pa.array(n, pa.int64()), "form": pa.array(np.array(FORMS)[form]),
               "prefix_chars": pa.array(chars[:, 0], pa.int64(), mask=plain),
               "middle_chars": pa.array(chars[:, 1] - chars[:, 0], pa.int64(), mask=plain),
               "output_sha256": table.sha256()}
        if text:
            new["output"] = table.texts()
        return with_columns(batch, [*new, "__h1", "__h2", "__h3", "__h4"], **new)

    return by_batch(work)


def _restored(into: str):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = PieceTable(batch.column("output"))
        named = batch.column("form").to_pylist()
        known = np.array([f in ARRANGEMENTS for f in named], bool)
        form = np.array([FORMS.index(f) if f in ARRANGEMENTS else 0 for f in named], np.int64)
        plain = form == FORMS.index("plain")
        order = _ORDERS[form]
        # the sentinel at the head of the text, the one in it and the last, in the form's order
        marks = np.take_along_axis(table.sentinel_at(), np.where(plain[:, None], 0, order[:, [0, 2, 4]]), 1)
        begin, end = table.offsets[:-1], table.offsets[1:]
        sound = known & (plain | ((marks[:, 0] == begin) & (marks[:, 1] > marks[:, 0]) & (marks[:, 2] > marks[:, 1])))
        marks = np.where((sound & ~plain)[:, None], marks, 0)
        # a plain text is a prefix, and the rest of it empty
        starts = np.where(plain[:, None], np.column_stack([begin, end, end]), marks + 3)
        ends = np.where(plain[:, None], end[:, None], np.column_stack([marks[:, 1:], end]))
        starts = np.where(sound[:, None], starts, 0)
        ends = np.where(sound[:, None], ends, 0)
        table.buffer, table.start, table.end = np.zeros_like(starts), starts, ends
        # of the parts in the form's order, the place of prefix, middle and suffix
        parts = np.where(plain[:, None], np.array([_PREFIX, _MIDDLE, _SUFFIX]), order[:, [1, 3, 5]])
        table.permute(np.argsort(parts, axis=1))
        return with_columns(batch, [into], **{into: table.texts(sound)})

    return by_batch(work)


def fill_in_middle(
    docs: DataFrame, key: Column | str = "doc_id", seed: int = 1, rate: int = RATE, spm: int = SPM, text: bool = True,
) -> DataFrame:
    """`docs` with n (units), form, prefix_chars and middle_chars (code points, null if plain),
    output_sha256 and output, the arranged text (left out unless `text`)."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    drawn = {f"__h{i + 1}": F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)}
    new = dict(n="long", form="string", prefix_chars="long", middle_chars="long", output_sha256="string")
    if text:
        new["output"] = "string"
    return docs.withColumns(drawn).mapInArrow(_arranged(rate, spm, text), schema_with(docs, **new))


def restore(arranged: DataFrame, into: str = "restored") -> DataFrame:
    """Add the texts that `output` and `form` were made of.

    Null if the form is none of the three or the sentinels aren't where the form has them.
    """
    return arranged.mapInArrow(_restored(into), schema_with(arranged, **{into: "string"}))
