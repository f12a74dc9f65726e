"""Exact Jaccard join of documents on word shingles, by T-occurrence search.

1. A document becomes the set of its distinct shingles (64-bit codes). Documents
   with equal sets form a class, known by a 128-bit digest; one member stands for
   all, so copies are never expanded into pairs.
2. Signatures split the classes into groups with no link between them. Sets that
   link differ in H shingles at most, so if the code range is cut into more than
   H equal parts, the sets agree in some. H follows from a band of set sizes;
   linked sets lie in one band or in neighbouring ones, and a set gives the
   signatures of its own band and of the band below. Sets that share a signature
   go to one group, however they are connected. Below SIGNED percent the parts are
   too small to tell sets apart, and groups are what candidate pairs connect: the
   rarest shingles of each set, in one order for all, are dealt by shingle, and two
   sets are candidates if their sizes fit and they share as many of these as a link
   of their sizes has to. A list of more than HOT sets makes a group as it is.
3. In a group, T-occurrence search finds the links: a set's short inverted lists
   are merged and counted, its long ones are only probed by binary search for
   what can still reach the overlap (DivideSkip). Only what connects documents
   matters, so a set that the group's main component has got already is
   not searched for again. A group too large for a task is dealt into blocks that
   share a few pivots; sets that the pivots don't connect are then searched for
   in every block.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z. A text of fewer words than a
shingle is one shingle as a whole. Null and empty texts have no shingles and link
with nothing. Rows that repeat an id are joined as documents of their own and
share its row in the components' minimum. A null id is never the smallest; a
component of null ids only has a null component_id.
"""

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.components import components
from meterflow.llm.words import by_batch, codes_of, joined, mix, schema_with, sliced
from meterflow.storage import materialise

SHINGLE, PERCENT = 3, 90
#: Shingles that a task searches in, about; a larger group is dealt into blocks.
BLOCK = 500_000
#: Sets of a group that are searched for first, in every block of it.
PIVOTS = 8
#: Lists of no more entries are always merged; lists that are probed at once.
SHORT, PROBES = 32, 64
#: Bits of the filter that says which documents to send to the search (64 MB at most).
BITS_PER_MEMBER, MOST_BITS = 16, 1 << 29
_FLUSH = 1 << 19
#: Groups come from signatures at this percentage or more, from candidate pairs below.
SIGNED = 90
#: Sets in a list of which all pairs are made; a longer list is linked to one of them.
HOT = 128
#: Shingles that SEEN texts or more have are frequent, at most MOST_FREQUENT of them (16 MB).
SEEN, MOST_FREQUENT = 24, 1_000_000


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle codes of each text."""
    codes, counts = codes_of(column)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    grams = np.zeros(max(0, len(codes) - size + 1), np.uint64)
    for i in range(size):
        grams += codes[i:i + len(grams)] * factors[i]
    grams = mix(grams)
    out = []
    for n, end in zip(counts, np.cumsum(counts)):
        if n >= size:
            out.append(np.unique(grams[end - n:end - size + 1]))
        else:  # the whole text, told from any shingle by its length
            whole = (codes[end - n:end] * factors[:n]).sum(keepdims=True) + np.uint64(n)
            out.append(mix(whole) if n else whole[:0])
    return out


def digest(codes: np.ndarray) -> bytes:
    return hashlib.md5(codes.tobytes(), usedforsecurity=False).digest()


def node_of(name: bytes) -> int:
    return int.from_bytes(name[:8], "little", signed=True)


class Bands:
    """Bands of set sizes: linked sets lie in one band or in two neighbouring ones."""

    def __init__(self, percent: int):
        self.percent, self.first = percent, [1]

    def of(self, n: int) -> int:
        while self.first[-1] <= n:
            self.first.append(100 * self.first[-1] // self.percent + 1)
        return bisect_right(self.first, n) - 1

    def parts(self, band: int) -> tuple[int, int]:
        """How many parts sets of this band and the next are cut into, and how many agree beyond the first."""
        while len(self.first) < band + 3:
            self.first.append(100 * self.first[-1] // self.percent + 1)
        most = self.first[band + 1] + self.first[band + 2] - 2
        differ = (100 - self.percent) * most // (100 + self.percent)
        spare = (differ + 1) // 8
        return differ + 1 + spare, spare

    def signatures(self, codes: np.ndarray) -> np.ndarray:
        """Codes of the parts, for the set's own band and the one below.

        Linked sets agree in more than `spare` parts. So a set with no more than that
        many parts of one shingle or none, which agree by chance, needs no signature of them.
        """
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(codes))])
        out = []
        own = self.of(len(codes))
        for band in (own, own - 1) if own else (own,):
            k, spare = self.parts(band)
            edges = np.arange(1, k, dtype=np.uint64) * np.uint64((1 << 64) // k - (k == 1))
            cuts = np.concatenate([[0], np.searchsorted(codes, edges), [len(codes)]])
            names = mix(sums[cuts[1:]] - sums[cuts[:-1]]
                        + mix(np.arange(k, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(band + 1)))
            strong = np.diff(cuts) > 1
            out.append(names[strong] if k - strong.sum() <= spare else names)
        return joined(out, np.uint64)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, digest, node) of each row: the set's digest and its first 8 bytes, null for an empty set."""

    def work(batch):
        sets = shingle_sets(batch.column("text"), size)
        names = [digest(s) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()),
             pa.array([node_of(d) if d else None for d in names], pa.int64())],
            names=["doc_id", "n_shingles", "digest", "node"])

    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(by_batch(work), schema_with(docs.select("doc_id"), n_shingles="long", digest="binary",
                                                        node="long"))


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, node) pairs that link what the given ones link: one for each key, and two for each link
    between its nodes, under a key of their own."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    centre = nodes[first][np.cumsum(first) - 1] if len(keys) else nodes
    links = np.unique(np.stack([nodes, centre])[:, nodes != centre], axis=1)
    own = mix(mix(links[0].view(np.uint64)) + links[1].view(np.uint64))
    return np.concatenate([keys[first], own, own]), np.concatenate([nodes[first], links[0], links[1]])


def _group_links(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links between classes (nodes) that share a signature.

    A task links the classes of a signature among its own documents first, and hands
    one of them on; so a signature that very many documents have makes one row a task.
    """

    def work(batches):
        bands = Bands(percent)
        keys, nodes, held = [], [], 0

        def flush():
            key, node = _stars(joined(keys, np.uint64), joined(nodes, np.int64))
            rows = pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node)], names=["key", "u"])
            return sliced(rows, 4 << 20)

        for batch in batches:
            for piece in sliced(batch, 4 << 20):
                for name, codes in {digest(s): s for s in shingle_sets(piece.column("text"), size) if len(s)}.items():
                    keys.append(bands.signatures(codes))
                    nodes.append(np.full(len(keys[-1]), node_of(name)))
                    held += len(keys[-1])
                if held >= _FLUSH:
                    yield from flush()
                    keys, nodes, held = [], [], 0
        yield from flush()

    rows = docs.select("text").mapInArrow(work, "key long, u long")
    return rows.withColumn("v", F.min("u").over(Window.partitionBy("key"))).where("u <> v").select("u", "v")


def _frequent(docs: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted codes of shingles that many of all texts have, and how many.

    They only settle the order of shingles, so any answer leads to the same links.
    """

    def work(batches):
        held, n = [], 0

        def flush():
            codes, counts = np.unique(joined(held, np.uint64), return_counts=True)
            rows = pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(counts)], names=["code", "n"])
            return sliced(rows, 4 << 20)

        for batch in batches:
            for piece in sliced(batch, 4 << 20):
                sets = shingle_sets(piece.column("text"), size)
                held += sets
                n += sum(len(s) for s in sets)
                if n >= _FLUSH:
                    yield from flush()
                    held, n = [], 0
        yield from flush()

    every = docs.select("text").mapInArrow(work, "code long, n long")
    counted = materialise(every.groupBy("code").agg(F.sum("n").alias("n")).where(F.col("n") >= SEEN), "frequent-shingles")
    least, total = SEEN, 0
    for row in counted.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy(F.desc("power")).collect():
        total += row["count"]
        if total > MOST_FREQUENT:
            least = 2 << row["power"]
            break
    got = counted.where(F.col("n") >= least).toArrow()
    codes, counts = (got.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("code", "n"))
    codes = codes.astype(np.int64).view(np.uint64)
    order = np.argsort(codes)
    return codes[order], counts[order]


class Prefixes:
    """The rarest shingles of sets, in one order: the frequent ones last, else by code.

    Linked sets share shingles in their prefixes. All that they share lies in both,
    but for what is beyond the prefix that ends first; so they share `least` there.
    """

    def __init__(self, percent: int, frequent: np.ndarray, counts: np.ndarray):
        self.percent, self.frequent, self.counts = percent, frequent, counts

    def length(self, n):
        """One more than a link may lack, and a twentieth of the set, which unrelated sets rarely share."""
        return np.minimum(n, n + -n * self.percent // 100 + 1 + n // 20)

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of a set's prefix: those that aren't frequent, and those that are."""
        length = int(self.length(len(codes)))
        at = np.searchsorted(self.frequent, codes)
        hit = np.zeros(len(codes), bool)
        inside = at < len(self.frequent)
        hit[inside] = self.frequent[at[inside]] == codes[inside]
        rare, often = codes[~hit][:length], codes[hit]
        return rare, often[np.argsort(self.counts[at[hit]], kind="stable")][:length - len(rare)]

    def least(self, n_x, n_y):
        """Shingles that linked sets of these sizes share in their prefixes at least."""
        overlap = -(-self.percent * (n_x + n_y) // (100 + self.percent))
        return overlap - np.maximum(n_x - self.length(n_x), n_y - self.length(n_y))

    def pairs(self, key: np.ndarray, node: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        """u, v and least of whole lists with their keys in a row: all pairs of which the sizes fit. In a list of more
        than HOT sets, or with a size of 0, all are linked to one (least 0)."""
        same = key[1:] == key[:-1]
        near = np.zeros(len(key), bool)
        near[1:] = same
        near[:-1] |= same
        key, node, n = key[near], node[near], n[near]
        if not len(key):
            return [np.zeros(0, np.int64)] * 3
        order = np.lexsort((node, n, key))
        key, node, n = key[order], node[order], n[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | (n[1:] != n[:-1])
        key, node, n = key[new], node[new], n[new]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(first, len(key)))
        star = np.repeat((sizes > HOT) | (n[first] == 0), sizes)
        centre = np.repeat(node[first], sizes)
        out = [(node[star], centre[star], np.zeros(star.sum(), np.int64))]
        longest = sizes[~star[first]].max(initial=1)
        key, node, n = key[~star], node[~star], n[~star]
        for d in range(1, longest):
            fits = (key[d:] == key[:-d]) & (n[:-d] * 100 >= n[d:] * self.percent)
            a, b = np.flatnonzero(fits), np.flatnonzero(fits) + d
            out.append((node[a], node[b], self.least(n[a], n[b])))
        return [np.concatenate(x) for x in zip(*out)]


def _candidate_links(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links between classes (nodes) that share as much of their prefixes as linked sets do.

    Classes that share a frequent shingle of their prefixes are linked as those that
    share a signature are, among a task's own documents first.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, size))

    def deal(batches):
        prefixes, bands, seen = Prefixes(percent, *shared.value), Bands(percent), set()
        keys, nodes, held = [], [], 0

        def rows(key, node, n):
            out = pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node), pa.array(n)],
                                             names=["key", "node", "n"])
            return sliced(out, 4 << 20)

        def flush():
            key, node = _stars(joined(keys, np.uint64), joined(nodes, np.int64))
            return rows(key, node, np.zeros(len(key), np.int32))

        for batch in batches:
            for piece in sliced(batch, 4 << 20):
                own, names, counts = [], [], []
                for codes in shingle_sets(piece.column("text"), size):
                    name = digest(codes)
                    if not len(codes) or name in seen:
                        continue
                    seen.add(name)
                    rare, often = prefixes.of(codes)
                    own.append(rare)
                    names.append(node_of(name))
                    counts.append((len(rare), len(codes)))
                    if len(often):
                        band = bands.of(len(codes))
                        for b in (band, band - 1) if band else (band,):
                            keys.append(mix(often + np.uint64(b + 1)))
                            nodes.append(np.full(len(often), names[-1]))
                            held += len(often)
                if own:
                    times, n = np.array(counts).T
                    yield from rows(joined(own, np.uint64), np.repeat(np.array(names, np.int64), times),
                                    np.repeat(n, times).astype(np.int32))
                if held >= _FLUSH:
                    yield from flush()
                    keys, nodes, held = [], [], 0
        yield from flush()

    def pair(batches):
        prefixes = Prefixes(percent, *shared.value)

        def rows(lists):
            columns = [pa.array(c) for c in prefixes.pairs(*lists)]
            return sliced(pa.RecordBatch.from_arrays(columns, names=["u", "v", "least"]), 4 << 20)

        rest = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            got = [np.concatenate([r, batch.column(c).to_numpy().astype(np.int64)]) for c, r in zip(("key", "node", "n"), rest)]
            end = int(np.searchsorted(got[0], got[0][-1])) if len(got[0]) else 0
            yield from rows([x[:end] for x in got])
            rest = [x[end:] for x in got]
            if len(rest[0]) > _FLUSH:  # one list: all are linked to its first, and some go on for it
                most = [x.copy() for x in rest]
                most[2][:] = 0
                yield from rows(most)
                kept = np.argmin(rest[1])
                rest = [np.full(1, rest[0][0]), np.full(1, rest[1][kept]), np.zeros(1, np.int64)]
        yield from rows(rest)

    dealt = docs.select("text").mapInArrow(deal, "key long, node long, n int")
    pairs = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(pair, "u long, v long, least long")
    ordered = pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), "least")
    return (ordered.groupBy("u", "v").agg(F.count("*").alias("times"), F.min("least").alias("least"))
            .where("times >= least").select("u", "v"))


class Search:
    """T-occurrence search among the sets of a group, for what overlaps enough to link."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent, self.n = sets, percent, np.array([len(s) for s in sets])
        every = joined(sets, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.n)
        self.codes, at = np.unique(every, return_inverse=True)
        #: the inverted lists, one after another: list number * sets + set number
        self.lists = np.sort(at.astype(np.int64) * len(sets) + owner)
        self.begin = np.searchsorted(self.lists, np.arange(len(self.codes) + 1, dtype=np.int64) * len(sets))

    def overlap(self, n_x, n_y):
        """Shingles that linked sets of these sizes share at least."""
        return -(-self.percent * (n_x + n_y) // (100 + self.percent))

    def linked(self, x: np.ndarray) -> np.ndarray:
        """Numbers of the sets that link with the set x (itself, if it is in the group)."""
        at = np.searchsorted(self.codes, x)
        at[at == len(self.codes)] = 0
        at = at[self.codes[at] == x]
        n, p = len(x), self.percent
        least = int(self.overlap(n, -(-n * p // 100)))
        if len(at) < least:
            return np.zeros(0, np.int64)
        low, high = self.begin[at], self.begin[at + 1]
        order = np.argsort(high - low, kind="stable")
        low, high, at = low[order], high[order], at[order]
        # the longest lists are probed: fewer than the overlap, so that a link has an entry in a short one
        sizes = high - low
        long = min(least - 1, int(least / (0.02 * np.log(max(2, sizes[-1])) + 1)), int((sizes > SHORT).sum()))
        short = len(at) - long
        sizes = sizes[:short]
        where = np.repeat(low[:short] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        # each list is in order of its sets, and the stable sort merges runs that are in order
        merged = np.sort(self.lists[where] % len(self.sets), kind="stable")
        begin = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        found, count = merged[begin], np.diff(np.append(begin, len(merged)))
        size = self.n[found]
        fits = (size * 100 >= n * p) & (n * 100 >= size * p) & (count >= self.overlap(n, size) - long)
        found, count = found[fits], count[fits]
        for end in range(len(at), short, -PROBES):
            begin = max(short, end - PROBES)
            keys = at[begin:end, None] * len(self.sets) + found
            spot = np.searchsorted(self.lists, keys)
            spot[spot == len(self.lists)] = 0
            count = count + (self.lists[spot] == keys).sum(0)
            # what can't reach the overlap any more needs no further probes
            able = count + (begin - short) >= self.overlap(n, self.n[found])
            found, count = found[able], count[able]
        return found[count >= self.overlap(n, self.n[found])]


class Forest:
    """Union-find over numbers."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, others: np.ndarray) -> None:
        roots = {self.root(int(y)) for y in others} | {self.root(x)}
        self.parent[list(roots)] = min(roots)

    def roots(self) -> np.ndarray:
        while not (self.parent == (up := self.parent[self.parent])).all():
            self.parent = up
        return self.parent


def connect(sets: list[np.ndarray], percent: int, pivots: int) -> np.ndarray:
    """The component of each set, as the number of a set in it. The first `pivots` sets are searched for
    first; then only those outside the largest component so far, which miss no link thereby."""
    search, forest = Search(sets, percent), Forest(len(sets))
    for x in range(min(pivots, len(sets))):
        forest.join(x, search.linked(sets[x]))
    roots = forest.roots()
    main = np.bincount(roots).argmax()
    for x in np.flatnonzero(roots != main):
        forest.join(int(x), search.linked(sets[x]))
    return forest.roots()


def _rows_of(batches: Iterator[pa.RecordBatch], size: int) -> dict:
    """The ranks and the set by group and digest, for rows whose text has the digest they were sent for."""
    out = {}
    for batch in batches:
        for piece in sliced(batch, 4 << 20):
            for s, d, g, q in zip(shingle_sets(piece.column("text"), size), piece.column("digest").to_pylist(),
                                  piece.column("grp").to_pylist(), piece.column("rank").to_pylist()):
                if digest(s) == d:
                    out.setdefault(g, {}).setdefault(d, (set(), s))[0].add(q)
    return out


def _edges_batch(edges: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.binary()) for i in (0, 1)], names=["u", "v"])


def _links(members: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links that connect the classes of each task's groups."""

    def work(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = []
        for rows in _rows_of(batches, size).values():
            names = sorted(rows, key=lambda d: (min(rows[d][0]), d))
            roots = connect([rows[d][1] for d in names], percent, PIVOTS)
            edges += [(names[i], names[r]) for i, r in enumerate(roots) if i != r]
        yield _edges_batch(edges)

    return members.groupBy("task").applyInArrow(work, "u binary, v binary")


def _links_across(members: DataFrame, size: int, percent: int) -> DataFrame:
    """(u, v): links from the sets with rank -1, which are looked for, to the others of each task."""

    def work(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = []
        for rows in _rows_of(batches, size).values():
            asked = {d: s for d, (ranks, s) in rows.items() if min(ranks) < 0}
            names = [d for d, (ranks, _) in rows.items() if max(ranks) >= 0]
            search = Search([rows[d][1] for d in names], percent) if names else None
            for d, s in asked.items() if search else ():
                edges += [(d, names[i]) for i in search.linked(s)]
        yield _edges_batch(edges)

    return members.groupBy("task").applyInArrow(work, "u binary, v binary")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of `docs`: the smallest doc_id that links reach."""
    sets = materialise(_sets(docs, size), "shingle-sets")
    near = components((_group_links if percent >= SIGNED else _candidate_links)(docs, size, percent))
    classes = sets.where("digest IS NOT NULL").groupBy("digest", "node", "n_shingles").agg(F.min("doc_id").alias("rep"))
    members = materialise(
        classes.join(near, "node").select("digest", "rep", "n_shingles", F.col("root").alias("grp")), "group-members")
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    # sets of large groups are dealt into blocks, after the pivots that all blocks get
    large = (members.groupBy("grp").agg(F.ceil(F.sum("n_shingles") / F.lit(block)).cast("int").alias("blocks"))
             .where("blocks > 1"))
    pivots = (members.join(large, "grp").groupBy("grp")
              .agg(F.slice(F.array_sort(F.collect_set(F.when(F.crc32("digest") % F.col("blocks") == 0, F.col("digest")))),
                           1, PIVOTS).alias("pivots")))
    tasks = max(1, -(-total // block))
    small = (members.join(large, "grp", "left_anti")
             .select("digest", "rep", "grp", F.lit(1).alias("rank"),
                     F.concat(F.lit("s"), F.pmod(F.xxhash64("grp"), F.lit(tasks)).cast("string")).alias("task")))
    dealt = materialise(
        members.join(large, "grp").join(pivots, "grp")
        .withColumn("pivot", F.array_contains("pivots", F.col("digest")))
        .withColumn("block", F.when(F.col("pivot"), F.sequence(F.lit(0), F.col("blocks") - 1))
                    .otherwise(F.array(F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))))
        .select("digest", "rep", "n_shingles", "grp", "pivot", "blocks", F.explode("block").alias("block")), "blocks")
    blocks = dealt.select("digest", "rep", "grp", F.when(F.col("pivot"), 0).otherwise(1).alias("rank"),
                          F.concat_ws("-", F.lit("b"), "grp", "block").alias("task"))
    docs = _chosen(docs, members)
    links = materialise(_links(_with_text(small.union(blocks), docs), size, percent), "links")
    if not dealt.isEmpty():
        links = links.union(_across_blocks(dealt, links, docs, size, percent, block))
    roots = components(links)
    named = sets.join(roots.select(F.col("node").alias("digest"), "root"), "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "digest").alias("root"))
    named = materialise(named, "named")
    least = materialise(  # so that the join below can split a very large component
        named.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    return (named.join(least, "root", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def _chosen(docs: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, text) of the members' documents and a few others, without a shuffle of the rest."""
    n = members.count()
    bits = min(MOST_BITS, 1 << (max(1 << 15, n * BITS_PER_MEMBER) - 1).bit_length())
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    parts = (members.select(place("rep").alias("at")).groupBy(F.expr("at div 32768").alias("part"))
             .agg(F.expr("bitmap_construct_agg(at % 32768)").alias("bits")))
    filled = np.zeros(bits // 8, np.uint8)
    for row in parts.toLocalIterator():  # 4 KB each, bits // 8 bytes in all
        filled[row["part"] * 4096:(row["part"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(filled)

    def work(batches):
        for batch in batches:
            at = batch.column("at").to_numpy()
            keep = (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(keep.astype(bool))).select(["doc_id", "text"])

    own = docs.select("doc_id", "text", place("doc_id").alias("at"))
    return own.mapInArrow(work, docs.select("doc_id", "text").schema)


def _with_text(members: DataFrame, docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    return (members.join(texts, members["rep"].eqNullSafe(texts["rep"]))
            .select("task", "grp", "rank", "digest", "text"))


def _across_blocks(dealt: DataFrame, links: DataFrame, docs: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    """Links between blocks of a large group, from the sets outside its main component."""
    own = dealt.select("digest").distinct()
    within = links.join(own.withColumnRenamed("digest", "u"), "u", "left_semi")
    roots = components(within).select(F.col("node").alias("digest"), "root")
    placed = (dealt.dropDuplicates(["digest"]).join(roots, "digest", "left")
              .withColumn("root", F.coalesce("root", "digest")))
    weights = placed.groupBy("grp", "root").agg(F.count("*").alias("weight"))
    main = weights.groupBy("grp").agg(F.max_by("root", F.struct("weight", "root")).alias("main"))
    rest = placed.join(main, "grp").where("root <> main")
    counts = rest.groupBy("grp").agg(F.ceil(F.sum("n_shingles") / F.lit(block)).cast("int").alias("chunks"))
    asked = (rest.join(counts, "grp").withColumn("chunk", F.pmod(F.xxhash64("digest", F.lit(1)), F.col("chunks")).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("digest", "rep", "grp", F.lit(-1).alias("rank"),
                     F.concat_ws("-", F.lit("x"), "grp", "block", "chunk").alias("task")))
    there = (dealt.join(counts, "grp").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("digest", "rep", "grp", F.lit(0).alias("rank"),
                     F.concat_ws("-", F.lit("x"), "grp", "block", "chunk").alias("task")))
    return materialise(_links_across(_with_text(asked.union(there), docs), size, percent), "links-across")


def keep_one(docs: DataFrame, percent: int = PERCENT, size: int = SHINGLE) -> DataFrame:
    """The document with the smallest id of each component, unchanged; of repeated rows, one.

    Of rows with the same id and text, the one with the smallest hash of the other columns
    stays. Documents without shingles, and those without an id, stay.
    """
    ids = (jaccard_components(docs, percent, size).where("doc_id IS NOT NULL").groupBy("doc_id")
           .agg(F.count("*").alias("__rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("__kept")))
    named = docs.join(materialise(ids.where("__kept").drop("__kept"), "kept"), "doc_id")
    # only rows of repeated ids are compared with each other
    others = [F.col(c).cast("string") for c in docs.columns if c not in ("doc_id", "text")]
    again = Window.partitionBy("doc_id", "text").orderBy(F.xxhash64(F.lit(0), *others), *others)
    first = (named.where("__rows > 1").withColumn("__place", F.row_number().over(again))
             .where("__place = 1").select(docs.columns))
    return (named.where("__rows = 1").select(docs.columns).unionByName(first)
            .unionByName(docs.where("doc_id IS NULL").select(docs.columns)))
