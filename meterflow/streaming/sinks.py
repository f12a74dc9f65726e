"""Sinks that stay right when a micro-batch is written twice."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def start_log(
    stream: DataFrame, path: str, checkpoint: str,
    make: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append", **trigger,
) -> StreamingQuery:
    """Write each micro-batch, or what `make` makes of it, to its own folder below `path`.

    A batch that is run again after a failure replaces its folder, so nothing
    counts twice. `trigger` defaults to all that is available.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if make is None else make(batch)
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
) -> DataFrame:
    """The latest row of every key in a log: what an upsert on `keys` would leave."""
    values = [f.name for f in schema.fields if f.name not in keys]
    newest = F.max(F.struct("batch_id", *values)).alias("_n")
    logged = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    log = spark.read.schema(logged).parquet(path)
    return log.groupBy(*keys).agg(newest).select(*keys, *[f"_n.{v}" for v in values])


def start_routed(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write rows with a `topic` column to one folder per topic, from one pass."""
    return _start_folders(stream, path, checkpoint, ["topic"], "parquet", trigger)


def start_archive(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "json", **trigger,
) -> StreamingQuery:
    """Append rows carrying the hour columns to their hour folders; the trigger sets the file size."""
    return _start_folders(
        stream, path, checkpoint, ["year", "month", "day", "hour"], fmt, trigger)


def start_push(
    rows: DataFrame, deliver: Callable[[DataFrame, int], None], checkpoint: str,
    min_interval: str = "500 milliseconds", mode: str = "append",
) -> StreamingQuery:
    """Hand rows to `deliver`, one call per micro-batch and at most one per `min_interval`."""
    return (
        rows.writeStream.outputMode(mode).foreachBatch(deliver)
        .option("checkpointLocation", checkpoint).trigger(processingTime=min_interval).start()
    )


def _start_folders(
    stream: DataFrame, path: str, checkpoint: str, by: Sequence[str], fmt: str, trigger: dict,
) -> StreamingQuery:
    return (
        stream.writeStream.format(fmt).partitionBy(*by).outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
