"""Spelling variants: words one code point apart, from a dictionary of trie node pairs.

The words' prefixes are the nodes of a trie, their suffixes those of a trie of the
reversed words, and both kinds are numbered. A word cut at any of its positions is a
pair of integers (prefix node, suffix node); with one code point skipped it is the pair
of the nodes on both sides of that. Two words that skip to the same pair differ by that one
code point; a word that skips to a pair at which another is cut has one code point more.
So equal pairs are neighbours, exactly, with no strings compared. The code point of
a run of equal ones can be left out anywhere with the same result, so only the first
counts as left out; each neighbour is then found at one position only. A pair is that
of one cut word and of as many skipped as the alphabet has letters, at most.

*Numbering.* Words are sorted in ranges, and a task reads a range once: a word shares
the nodes of the word before as far as they agree, and its further prefixes get the next
numbers. Prefixes of the words at which ranges begin are the only ones that several
ranges have; they are numbered beforehand. Those border words are at most BORDERS
beginnings of words, of BORDER_CHARS, drawn by hash: they decide where tasks begin, not
what comes out. A task holds one word and its nodes at a time, so words may be long
and ranges uneven.

Words are what `words` finds: maximal runs of `[A-Za-z\\u00C0-\\u00FF]`, A-Z lower-cased, of at
least `least_chars` code points, found at least `least_n` times. If `damage` divides the
CRC-32 of `<key>:<run>`, the run loses the code point at that CRC modulo its length, before
it is measured (a stand-in for misspellings; 0 turns it off). A word's form is its most
frequent neighbour (ties: the smallest in code-point order) if that one is `ratio` times as
frequent at least; the root is where the forms lead. Frequencies rise along them, so they end.

Null and empty texts have no words, a null key counts as an empty one, repeated rows count as
often as they occur, further columns are ignored, and an empty table gives no rows.
"""

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.llm.shared import Shared
from meterflow.storage import materialise

LEAST_CHARS, LEAST_N, RATIO, DAMAGE = 6, 5, 5, 199
#: Words to a range, and the most ranges.
RANGE, RANGES = 100_000, 1000
#: Border words that are drawn for each range, and the code points kept of one.
DRAWN, BORDER_CHARS = 16, 64
BORDERS = RANGES * DRAWN
#: Numbers kept for the nodes of a range; below the first of them are those of the borders.
_SPAN = 1 << 44
#: What a row of the dictionary is: the word cut here; skipping this code point, the same as the one before or not.
_CUT, _SAME, _FIRST = 0, 1, 2


def words(docs: DataFrame, key: Column | str = "doc_id", least_chars: int = LEAST_CHARS, least_n: int = LEAST_N,
          damage: int = DAMAGE) -> DataFrame:
    """(word, n) of all texts."""
    key = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    # a quantifier that takes all it can, so a run is taken whole or, if too short, not at all
    runs = F.regexp_extract_all("text", F.lit(f"([A-Za-zÀ-ÿ]{{{least_chars},}})"))
    found = docs.select(key.alias("k"), F.explode(runs).alias("run"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = found.select("k", F.translate("run", upper, upper.lower()).alias("run"))
    word = F.col("run")
    if damage:
        crc = F.crc32(F.concat("k", F.lit(":"), "run").cast("binary"))
        lowered = lowered.select("run", crc.alias("crc"))
        at = (F.col("crc") % F.length("run")).cast("int")
        less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
        word = F.when(F.col("crc") % damage == 0, less).otherwise(F.col("run"))
    return lowered.select(word.alias("word")).where(F.length("word") >= least_chars)\
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_n)


class Borders:
    """The beginnings of the ranges, and the numbers of their own prefixes."""

    def __init__(self, drawn: list[str], ranges: int):
        drawn = sorted(set(drawn))
        steps = {len(drawn) * i // ranges for i in range(1, ranges)}
        self.first = [drawn[i] for i in sorted(steps) if i < len(drawn)]
        self.nodes, next_ = [], 1
        path: list[int] = []
        for before, border in zip(["", *self.first], self.first):
            path = path[:agreed(before, border)]
            path += range(next_, next_ + len(border) - len(path))
            next_ = max(next_, path[-1] + 1)
            self.nodes.append(path)

    def range_of(self, word: str) -> int:
        """The number of borders that aren't after the word."""
        return bisect_right(self.first, word)

    def around(self, part: int) -> list[tuple[str, list[int]]]:
        """The border at which a range begins, and that at which it ends, with their nodes."""
        return [(self.first[i], self.nodes[i]) for i in (part - 1, part) if 0 <= i < len(self.first)]


def agreed(a: str, b: str) -> int:
    """How many code points two words have in common from the left."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    i = 0
    while a[i] == b[i]:
        i += 1
    return i


class Numbers:
    """Numbers the prefixes of the words of sorted ranges, as they pass."""

    def __init__(self, borders: Borders):
        self.borders, self.part = borders, None

    def nodes(self, part: int, word: str) -> list[int]:
        """The nodes of the word's prefixes, from the empty one (0) to the word."""
        if part != self.part:
            self.part, self.next, self.word, self.path = part, (part + 1) * _SPAN, "", []
            self.around = self.borders.around(part)
        path = self.path[:agreed(self.word, word)]
        for border, known in self.around:
            shared = agreed(border, word)
            if shared > len(path):
                path += known[len(path):shared]
        more = len(word) - len(path)
        path += range(self.next, self.next + more)
        self.next += more
        self.word, self.path = word, path
        return [0, *path]


def _in_ranges(words: DataFrame, column: str) -> tuple[DataFrame, Shared]:
    """The words sorted by `column` within ranges, numbered `part`."""
    spark = words.sparkSession
    ranges = min(RANGES, max(1, -(-words.count() // RANGE)))
    drawn = words.select(F.substring(column, 1, BORDER_CHARS).alias("b")).orderBy(F.xxhash64(column), column)\
        .limit(ranges * DRAWN).collect()  # BORDERS of BORDER_CHARS at most
    borders = Shared(spark, Borders([r.b for r in drawn], ranges))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = borders.value
        for batch in batches:
            part = pa.array([b.range_of(w) for w in batch.column(column).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, part], names=[*batch.schema.names, "part"])

    schema = ", ".join(f"{n} {t}" for n, t in words.dtypes) + ", part long"
    placed = words.mapInArrow(place, schema).repartition(ranges, "part").sortWithinPartitions("part", column)
    return placed, borders


def numbered(words: DataFrame) -> DataFrame:
    """(id, word, n, prefixes): ids in the words' order, and the numbers of their prefixes."""
    placed, borders = _in_ranges(words.select("word", "n"), "word")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, last, at = Numbers(borders.value), None, 0
        for batch in batches:
            ids, nodes = [], []
            for part, word in zip(batch.column("part").to_pylist(), batch.column("word").to_pylist()):
                at = at + 1 if part == last else part * _SPAN
                last = part
                ids.append(at)
                nodes.append(numbers.nodes(part, word))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), batch.column("word"), batch.column("n"), pa.array(nodes, pa.list_(pa.int64()))],
                names=["id", "word", "n", "prefixes"])

    return placed.mapInArrow(work, "id long, word string, n long, prefixes array<long>")


def node_pairs(words: DataFrame) -> DataFrame:
    """The dictionary: for each cut and skip of each of the numbered words its pair, kind, id and n."""
    turned = words.select("id", "n", F.reverse("word").alias("reversed"), "prefixes")
    placed, borders = _in_ranges(turned, "reversed")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers(borders.value)
        for batch in batches:
            for piece in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                prefix, suffix, kind = [], [], []
                sizes = []
                columns = (piece.column(c).to_pylist() for c in ("part", "reversed", "prefixes"))
                for part, word, before in zip(*columns):
                    after = numbers.nodes(part, word)[::-1]
                    prefix += before + before[:-1]
                    suffix += after + after[1:]
                    kind += [_CUT] * len(before)
                    word = word[::-1]
                    kind.append(_FIRST)
                    kind += [_SAME if a == b else _FIRST for a, b in zip(word, word[1:])]
                    sizes.append(2 * len(word) + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix, pa.int64()), pa.array(suffix, pa.int64()), pa.array(kind, pa.int8()),
                     pa.array(np.repeat(piece.column("id").to_numpy(), sizes)),
                     pa.array(np.repeat(piece.column("n").to_numpy(), sizes))],
                    names=["prefix", "suffix", "kind", "id", "n"])

    return placed.mapInArrow(work, "prefix long, suffix long, kind byte, id long, n long")


def _better(n: np.ndarray, id_: np.ndarray, other_n: np.ndarray, other_id: np.ndarray):
    """The more frequent of two words, row by row; of equals the one of the smaller id."""
    other = (other_n > n) | ((other_n == n) & (other_id < id_))
    return np.where(other, other_n, n), np.where(other, other_id, id_)


def _neighbours(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """What whole groups of equal pairs say of their words: the number of neighbours, and the best one.

    In a group the cut word comes first, if there is one, then those that skip to it from the most frequent on.
    """
    prefix, suffix, kind, id_, n = (rows[c] for c in ("prefix", "suffix", "kind", "id", "n"))
    size = len(id_)
    head = np.ones(size, bool)
    head[1:] = (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1])
    starts = np.flatnonzero(head)
    group = np.cumsum(head) - 1
    ends = np.append(starts[1:], size)
    cut = kind[starts] == _CUT
    skip = starts + cut
    skips = ends - skip
    # neighbours that have another code point there: all others that skip, the best being first or second
    is_skip = kind != _CUT
    place = np.arange(size)
    best = np.minimum(np.where(place == skip[group], skip[group] + 1, skip[group]), size - 1)
    some = is_skip & (skips[group] > 1)
    count = np.where(some, skips[group] - 1, 0)
    best_n, best_id = np.where(some, n[best], 0), np.where(some, id_[best], 0)
    # the cut word has one code point less than each that leaves out the first of its run
    first = kind == _FIRST
    shorter = first & cut[group]
    own = starts[group]
    count += shorter
    best_n, best_id = _better(best_n, best_id, np.where(shorter, n[own], 0), id_[own])
    longer = np.add.reduceat(first.astype(np.int64), starts)
    at = np.where(first, place, size)
    top = np.minimum(np.minimum.reduceat(at, starts), size - 1)
    which = np.flatnonzero(cut & (longer > 0))
    count[starts[which]], best_n[starts[which]], best_id[starts[which]] = longer[which], n[top[which]], id_[top[which]]
    keep = count > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(id_[keep]), pa.array(count[keep].astype(np.int64)), pa.array(best_n[keep]), pa.array(best_id[keep])],
        names=["id", "n_near", "best_n", "best_id"])


def _by_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`_neighbours` of sorted rows; a batch's last group waits for the next batch."""
    names = ("prefix", "suffix", "kind", "id", "n")
    rest = None
    for batch in batches:
        rows = {c: batch.column(c).to_numpy() for c in names}
        if rest is not None:
            rows = {c: np.concatenate([rest[c], rows[c]]) for c in names}
        if not len(rows["id"]):
            continue
        last = (rows["prefix"] == rows["prefix"][-1]) & (rows["suffix"] == rows["suffix"][-1])
        whole = int(np.argmax(last))
        rest = {c: rows[c][whole:] for c in names}
        if whole:
            yield _neighbours({c: rows[c][:whole] for c in names})
    if rest is not None:
        yield _neighbours(rest)


def nearest(pairs: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best_id) of the words that have neighbours."""
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = pairs.repartition(tasks, "prefix", "suffix").sortWithinPartitions(
        "prefix", "suffix", F.col("kind") != _CUT, F.desc("n"), "id")
    found = together.mapInArrow(_by_groups, "id long, n_near long, best_n long, best_id long")
    best = F.max(F.struct("best_n", (-F.col("best_id")).alias("less")))
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "id", "n_near", F.col("b.best_n").alias("best_n"), (-F.col("b.less")).alias("best_id"))


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, form): each round goes twice as far, until no root has a form."""
    reached = materialise(forms.select("id", F.col("form").alias("root")), "forms")
    while True:
        on = reached.select(F.col("id").alias("root"), F.col("root").alias("next"))
        if reached.join(on, "root", "left_semi").isEmpty():
            return reached
        reached = materialise(reached.join(on, "root", "left").select(
            "id", F.coalesce("next", "root").alias("root")), "forms")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n) with n_near, form, form_n and root of each word; every word is given once."""
    known = materialise(numbered(materialise(words.select("word", "n"), "words")), "numbered")
    near = materialise(nearest(node_pairs(known)), "near")
    plain = known.select("id", "word", "n")
    judged = plain.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_id")).alias("form_id"))
    ends = roots(judged.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    to = lambda name: plain.select(
        F.col("id").alias(f"{name}_id"), F.col("word").alias(name), F.col("n").alias(f"{name}_n"))
    named = judged.where("form_id IS NOT NULL").select("id", "form_id")\
        .join(ends.select("id", F.col("root").alias("root_id")), "id")\
        .join(to("form"), "form_id").join(to("root"), "root_id").select("id", "form", "form_n", "root")
    return judged.drop("form_id").join(named, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
