"""Where rows go: topics, partitions, push rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.meters import zone_partition
from meterflow.functions.times import iso_text
from meterflow.schema import ZONE_AGG_SCHEMA

READINGS_TOPIC = "meter.readings"
ALERTS_TOPIC = "meter.alerts"


def route_alerts(df: DataFrame) -> DataFrame:
    """A row per topic a reading goes to: every reading to one, alerts to both."""
    topics = F.when(
        F.col("event_type") == "alert", F.array(F.lit(READINGS_TOPIC), F.lit(ALERTS_TOPIC))
    ).otherwise(F.array(F.lit(READINGS_TOPIC)))
    return with_partition(df).withColumn("topic", F.explode(topics))


def with_partition(df: DataFrame) -> DataFrame:
    """Add the partition number the zone is routed to."""
    return df.withColumn("partition", zone_partition(F.col("zone_id")))


def to_push_rows(windows: DataFrame) -> DataFrame:
    """Window rows as the live board takes them: ISO times, no NULL change."""
    return windows.withColumns({
        "window_start_ts": iso_text(F.col("window_start_ts")),
        "window_end_ts": iso_text(F.col("window_end_ts")),
        "demand_vs_prev_window_pct": F.coalesce("demand_vs_prev_window_pct", F.lit(0.0)),
    }).select(*ZONE_AGG_SCHEMA.names)


def push_payload(rows: DataFrame) -> DataFrame:
    """Push rows as one JSON array each, `payload`."""
    return rows.select(F.to_json(F.array(F.struct(*rows.columns))).alias("payload"))
