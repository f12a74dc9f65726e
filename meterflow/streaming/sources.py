"""Streaming sources of readings."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.schema import READING_SCHEMA
from meterflow.sources.raw import with_judged
from meterflow.sources.readings import EVENTS_SCHEMA, from_events


def read_stream(
    spark: SparkSession, source: str, *, path: str | None = None, servers: str | None = None,
    topic: str = "meter.readings", starting: str = "earliest", max_files: int = 1000,
    max_offsets: int = 5_000_000, keyed: bool = True,
) -> DataFrame:
    """Messages as `key` and `value` text, with their `partition`, `offset` and time of arrival.

    `source="kafka"` reads a topic (its package has to be on the class path);
    `source="files"` replays JSON Lines below `path`, keyed by zone, where the
    last three are NULL. Without `keyed` they have no `key`, for which each text would be
    parsed. Both limit what one micro-batch takes in.
    """
    if source == "kafka":
        messages = (
            spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", max_offsets).load()
        )
        return messages.select(
            F.col("key").cast("string"), F.col("value").cast("string"), "partition", "offset",
            F.col("timestamp").alias("arrived"))
    if source == "files":
        lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
        return lines.select(
            *([zone_key()] if keyed else []), "value",
            F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset"),
            F.lit(None).cast("timestamp").alias("arrived"))
    raise ValueError(f"unknown source {source!r}")


def zone_key() -> Column:
    """The zone of a message as its `key`."""
    return F.get_json_object("value", "$.zone_id").alias("key")


def check_messages(messages: DataFrame, names: Sequence[str] = READING_SCHEMA.names) -> DataFrame:
    """Every message with its typed fields and `reason`, why it cannot be used; NULL if it can.

    `arrival_seq` orders the messages of a meter: the offset, and without one the number in the event id.
    `names` are the fields that are asked for; `timestamp` becomes `reading_ts`.
    """
    judged = with_judged(messages, [*names, "event_id", "timestamp"])
    fields = {name: F.col(f"fields.{name}") for name in READING_SCHEMA.names if name in names}
    fields.pop("timestamp", None)
    fields["reading_ts"] = F.col("fields.timestamp").try_cast("timestamp_ntz")
    typed = [value.alias(name) for name, value in fields.items()]
    seq = F.coalesce("offset", F.col("fields.event_id").try_cast("long"))
    return judged.select(*messages.columns, "reason", *typed, seq.alias("arrival_seq"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Typed readings of the messages that are usable; `dead_letters` has the others."""
    return check_messages(messages).filter(F.col("reason").isNull()).drop("reason", "key", "value")


def dead_letters(messages: DataFrame) -> DataFrame:
    """The messages that cannot be used, as they came, with the reason."""
    return check_messages(messages).filter(F.col("reason").isNotNull()).select(
        *messages.columns, "reason")


def replay_readings(spark: SparkSession, sf_dir: str, max_files: int = 1000) -> DataFrame:
    """The events table as a stream of readings.

    The path is a pattern, as a plain one would have to be a folder.
    """
    events = (
        spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
        .parquet(f"{sf_dir}/events.parque[t]")
    )
    return from_events(events)
