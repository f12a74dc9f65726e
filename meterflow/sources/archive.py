"""The raw archive: files in year/month/day/hour folders of the event time (UTC)."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.sources.raw import PARTITIONS

HOUR_COLS = ["year", "month", "day", "hour"]


def with_hour_parts(df: DataFrame, ts: str = "reading_ts") -> DataFrame:
    """Add the zero-padded folder values of the event time."""
    parts = {
        "year": F.year(ts).cast("string"),
        "month": F.lpad(F.month(ts).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"),
        "hour": F.lpad(F.hour(ts).cast("string"), 2, "0"),
    }
    return df.withColumns(parts)


def write_archive(
    df: DataFrame, path: str, fmt: str = "json", ts: str = "reading_ts",
    max_records_per_file: int = 5_000_000, mode: str = "append",
) -> None:
    """Write rows to their hour folders.

    The rebalance gathers an hour into few files, and splits the hours that
    are too large for one task. Text output takes a single `value` column.
    """
    parted = with_hour_parts(df, ts)
    if fmt == "text":
        parted = parted.select("value", *HOUR_COLS)
    (
        parted.hint("rebalance", *HOUR_COLS)
        .write.mode(mode).partitionBy(*HOUR_COLS)
        .option("maxRecordsPerFile", max_records_per_file)
        .format(fmt).save(path)
    )


def hours_between(start: datetime, end: datetime) -> Column:
    """Predicate on the folder columns for event hours in [start, end); prunes partitions."""
    folder = F.make_timestamp_ntz(
        F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0))
    return (folder >= F.lit(start).cast("timestamp_ntz")) & (
        folder < F.lit(end).cast("timestamp_ntz"))


def ready_hours(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Hour folders holding at least one file; lists the files without opening them."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .schema(f"path string, modificationTime timestamp, length long, content binary, {PARTITIONS}")
        .load(path)
    )
    return files.groupBy(*HOUR_COLS).agg(F.count("path").alias("files"))
