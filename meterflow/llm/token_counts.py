"""Exact token counts of whole texts under a byte-level BPE vocabulary, without a shuffle.

A text is cut into pre-tokens, which never share a token, and the lengths of its
pre-tokens are summed. Two tiers know the lengths: a broadcast table of the most
frequent pre-tokens, and a cache in each worker process, which encodes what is in
neither with the tokenizers library and lasts from task to task. The table holds the
vocabulary entries that are pre-tokens by themselves: the entries of a BPE vocabulary
are its training corpus's most frequent strings, so the table needs no pass over the
documents and is bounded by the vocabulary.

Null and empty texts have no tokens. Strings of special tokens in a text count as one
token, the library's default. Texts with rare characters, of which Python's pattern
library and the tokenizer's may know different classes, are encoded whole by the
library. Long texts are cut where a pre-token has to begin. Rows repeat as they come,
and other columns pass through.
"""

import json
import os
import sys
import types

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from meterflow.llm.shared import Shared
from meterflow.llm.words import by_batch, schema_with, with_columns

#: Pre-tokens that a worker process remembers at most (about 100 MB).
CACHE = 500_000
#: Characters that are cut into pre-tokens at once.
PIECE = 1 << 20
# The pre-tokenizer pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose classes don't differ between versions of Unicode.
_RARE = regex.compile(r"[^\u0000-\u0557\u2010-\u2064\u3041-\u3096\u30A1-\u30FA\u4E00-\u9FA5\uAC00-\uD7A3]")
_CUT = regex.compile(r"(?<=\S) (?=\S)")


def process_store(name: str) -> dict:
    """A dict that lives as long as the worker process, whichever task asks for it."""
    holder = sys.modules.setdefault("_meterflow_process", types.ModuleType("_meterflow_process"))
    return holder.__dict__.setdefault(name, {})


class Counter:
    """Token counts in one process."""

    def __init__(self, spec: str, frequent: dict[str, int], cache: dict):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(spec)
        self.frequent, self.cache = frequent, cache
        self.pattern = regex.compile(PATTERN)
        special = [t["content"] for t in json.loads(spec)["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def pieces(self, text: str):
        """The text in lists of pre-tokens; long texts come in several lists."""
        at = 0
        while len(text) - at > PIECE and (cut := _CUT.search(text, at + PIECE)):
            yield self.pattern.findall(text, at, cut.start())
            at = cut.start()
        yield self.pattern.findall(text[at:] if at else text)

    def learn(self, pieces: set[str]) -> None:
        """Encode the pre-tokens that neither tier knows."""
        new = [p for p in pieces if p not in self.frequent and p not in self.cache]
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = [p for p in pieces if p not in self.frequent]
        for at in range(0, len(new), 10_000):
            some = new[at:at + 10_000]
            self.cache.update(zip(some, map(len, self.tokenizer.encode_batch(some, add_special_tokens=False))))

    def lengths(self, pieces: list[str]) -> int:
        known, cached = self.frequent.get, self.cache
        return sum(n if (n := known(p)) is not None else cached[p] for p in pieces)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if _RARE.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        parts, n = [text], 0
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            n = len(parts) - 1
        for part in parts:
            for pieces in self.pieces(part):
                self.learn(set(pieces))
                n += self.lengths(pieces)
        return n


def frequent_lengths(spec: str) -> dict[str, int]:
    """Lengths of the vocabulary entries that are one pre-token."""
    from tokenizers import Tokenizer

    tokenizer, pattern = Tokenizer.from_str(spec), regex.compile(PATTERN)
    special = {t["content"] for t in json.loads(spec)["added_tokens"]}
    words = [tokenizer.decode([i], skip_special_tokens=False) for i in range(tokenizer.get_vocab_size())]
    words = [w for w in words if w and w not in special and not _RARE.search(w) and pattern.findall(w) == [w]]
    return dict(zip(words, map(len, tokenizer.encode_batch(words, add_special_tokens=False))))


def count_tokens(docs: DataFrame, path: str, text: str = "text", into: str = "n_tokens") -> DataFrame:
    """`docs` with the number of tokens of each whole text, under the tokenizer file at `path`.

    A column named by `into` is replaced. The file has to be of byte-level BPE
    without a normalizer, a prefix space, or post-processing.
    """
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    kind = json.loads(spec)
    splitter, added = kind["pre_tokenizer"] or {}, kind["added_tokens"]
    if (kind["model"].get("type") != "BPE" or kind["normalizer"] or kind["post_processor"]
            or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True)
            or any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)):
        raise ValueError(f"not a plain byte-level BPE tokenizer: {path}")
    shared = Shared(docs.sparkSession, (spec, frequent_lengths(spec)))

    def work(batches):
        store = process_store("token-counts")
        if store.get("path") != path:
            store.clear()
            store.update(path=path, counter=Counter(*shared.value, cache={}))
        counter = store["counter"]

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [counter.count(t) for t in batch.column(text).to_pylist()]
            return with_columns(batch, drop=[into], **{into: pa.array(counts, pa.int64())})

        yield from by_batch(one)(batches)

    return docs.mapInArrow(work, schema_with(docs, **{into: "long"}))
