"""Zone windows over a stream.

Both ways keep sums per zone, window and meter. The distinct meters of a window
are then the rows of it, so nothing grows with the fleet of a zone, and a busy
zone or meter is pre-aggregated before any shuffle.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.functions.numbers import kwh_units, round_half_up
from meterflow.functions.times import (
    as_instant, as_wall_time, check_window, floor_window, seconds_interval,
)
from meterflow.operators.windows import Expected, in_window_order, with_demand_delta, with_silent
from meterflow.schema import WINDOW_SECONDS
from meterflow.streaming.sinks import start_log

PART_KEYS = ["zone_id", "window_start_ts", "meter_id"]
SUMS = ["units", "readings", "kw_sum", "pf_sum", "volt_sum", "hz_sum", "degraded", "fault",
        "anomalies"]
PART_SCHEMA = (
    "zone_id string, window_start_ts timestamp_ntz, meter_id string, units long, readings long, "
    "kw_sum double, kw_max double, pf_sum double, volt_sum double, hz_sum double, "
    "degraded long, fault long, anomalies long"
)


def start_window_log(
    stream: DataFrame, path: str, checkpoint: str, seconds: int = WINDOW_SECONDS,
    anomaly: str | None = None, **trigger,
) -> StreamingQuery:
    """Log the window parts of each micro-batch; `read_windows` adds them up.

    Needs no state and no watermark: a reading counts in its own window however
    late it comes, and the last windows are there without a flush.
    """
    check_window(seconds)
    return start_log(
        stream, path, checkpoint, lambda batch: window_parts(batch, seconds, anomaly), **trigger)


def window_parts(batch: DataFrame, seconds: int = WINDOW_SECONDS, anomaly: str | None = None) -> DataFrame:
    """Sums per zone, window and meter of the readings of a micro-batch."""
    start = floor_window(F.col("reading_ts"), seconds).alias("window_start_ts")
    return batch.groupBy("zone_id", start, "meter_id").agg(*_part_sums(anomaly))


def closed_windows(
    stream: DataFrame, seconds: int = WINDOW_SECONDS, delay: str = "10 minutes",
    anomaly: str | None = None,
) -> DataFrame:
    """Zone windows of a stream, each given out once, when it is `delay` behind the newest reading.

    For the live board. Readings later than `delay` are dropped; the query's
    progress counts them. State is a row per meter, and then per zone, of the
    windows still open.
    """
    check_window(seconds)
    parts = (
        stream.withColumn("at", as_instant(F.col("reading_ts"))).withWatermark("at", delay)
        .groupBy("zone_id", F.window("at", f"{seconds} seconds").alias("w"), "meter_id")
        .agg(*_part_sums(anomaly))
    )
    windows = parts.groupBy("zone_id", "w").agg(*_measures(anomaly is not None))
    started = windows.withColumn("window_start_ts", as_wall_time(F.col("w.start")))
    return _ended(started, seconds)


def read_windows(
    spark: SparkSession, path: str, seconds: int = WINDOW_SECONDS, expected: Expected = None,
    with_anomalies: bool = False, since: Column | None = None,
) -> DataFrame:
    """Zone windows from the log of window parts, those from `since` on."""
    log = spark.read.schema(PART_SCHEMA).parquet(path)
    if since is not None:
        log = log.filter(F.col("window_start_ts") >= since)
    ended = windows_of_parts(log, seconds, with_anomalies)
    return ended if expected is None else in_window_order(with_silent(ended, expected))


def merged_parts(parts: DataFrame) -> DataFrame:
    """One row per zone, window and meter."""
    return parts.groupBy(*PART_KEYS).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.max("kw_max").alias("kw_max"))


def windows_of_parts(parts: DataFrame, seconds: int = WINDOW_SECONDS, with_anomalies: bool = False) -> DataFrame:
    """The measures of each zone and window."""
    measured = _measures(with_anomalies)
    return _ended(merged_parts(parts).groupBy("zone_id", "window_start_ts").agg(*measured), seconds)


def read_window_deltas(
    spark: SparkSession, path: str, seconds: int = WINDOW_SECONDS, expected: Expected = None,
    with_anomalies: bool = False,
) -> DataFrame:
    """As `read_windows`, with the change to the window before."""
    return with_demand_delta(read_windows(spark, path, seconds, expected, with_anomalies))


def _part_sums(anomaly: str | None) -> list[Column]:
    flagged = F.count_if(F.col(anomaly)) if anomaly else F.sum(F.lit(0))
    return [
        F.sum(kwh_units(F.col("kwh_delta"))).alias("units"),
        F.count("*").alias("readings"),
        F.sum("power_kw").alias("kw_sum"),
        F.max("power_kw").alias("kw_max"),
        F.sum("power_factor").alias("pf_sum"),
        F.sum("voltage").alias("volt_sum"),
        F.sum("frequency_hz").alias("hz_sum"),
        F.count_if(F.col("meter_state") == "degraded").alias("degraded"),
        F.count_if(F.col("meter_state") == "fault").alias("fault"),
        flagged.alias("anomalies"),
    ]


def _measures(with_anomalies: bool) -> list[Column]:
    n = F.nullif(F.sum("readings"), F.lit(0))
    counted = [F.sum("anomalies").alias("anomaly_count")] if with_anomalies else []
    return [
        (F.sum("units") / 10000.0).alias("total_kwh"),
        round_half_up(F.sum("kw_sum") / n, 3).alias("avg_power_kw"),
        round_half_up(F.greatest(F.lit(0.0), F.max("kw_max")), 3).alias("peak_power_kw"),
        round_half_up(F.sum("pf_sum") / n, 3).alias("avg_power_factor"),
        round_half_up(F.sum("volt_sum") / n, 2).alias("avg_voltage"),
        round_half_up(F.sum("hz_sum") / n, 3).alias("avg_frequency_hz"),
        F.count("*").alias("active_meter_count"),
        F.sum("degraded").alias("degraded_count"),
        F.sum("fault").alias("fault_count"),
        *counted,
    ]


def _ended(windows: DataFrame, seconds: int) -> DataFrame:
    end = F.col("window_start_ts") + seconds_interval(seconds)
    return in_window_order(windows.withColumn("window_end_ts", end))
