"""The corpus pipeline: stages over whole documents, each fed what its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import decontaminate, jaccard, line_dedup, mixing, toxicity
from meterflow.storage import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, doesn't call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that an earlier document holds; n_chars follows the text."""
    return line_dedup.without_repeats(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that the n-gram Jaccard join connects.

    Near-duplicate rule of the pipeline: shingles of five words, a similarity of 0.8 or more.
    """
    return jaccard.keep_one(docs, percent=80, size=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is in benchmark windows."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents selected for the target weights, with n_tokens and copies."""
    return mixing.mix_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
]

#: The toxicity stage can't be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over `documents`; what each keeps is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
