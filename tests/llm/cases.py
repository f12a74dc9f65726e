"""Awkward rows that every operator has to take, and plain versions of shared rules."""

import re
import zlib

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "Long words of one very long line, " * 6000
#: doc_id, text: null and empty texts, white space, a very long text, repeated rows, a null id, ties
ROWS = [
    (1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "one"), (6, "One Two"), (7, "alpha beta gamma delta"),
    (7, "alpha beta gamma delta"), (8, "ALPHA beta gamma delta"), (None, "alpha beta gamma delta epsilon"),
    (9, "Ünïcode é 日本 😀 words here"), (10, "a line of some length\nshort\nanother line of length\n"),
    (11, "A LINE of some length  \nshort\nnew line of its own"), (12, "x" * 5000), (13, "é \x00 \x1f   z"),
]
SCHEMA = "doc_id long, text string"
#: columns named like those that operators add or use inside
EXTRA = ["score", "n_tokens", "N_Words", "items", "hits", "n_lines", "key", "label", "lang", "source", "copies", "block",
         "shard", "code", "rank", "digest", "node", "u", "v", "root", "grp", "task", "slice"]


def edge_docs(spark, rows=ROWS):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in EXTRA:
        docs = docs.selectExpr("*", f"concat('kept ', '{name}') AS {name}")
    return docs


def empty_docs(spark):
    return edge_docs(spark, [])


def extras_kept(df, replaced=()):
    """The extra columns have come through as they were."""
    gone = {r.lower() for r in replaced}
    names = [n for n in EXTRA if n.lower() not in gone]
    assert set(names) <= set(df.columns)
    for row in df.select(names).distinct().collect():
        assert list(row) == [f"kept {n}" for n in names]


def lower(text):
    return (text or "").translate(_LOWER)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def documents(spark, sf, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select(*columns).collect()]
