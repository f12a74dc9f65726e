"""The hourly moving average over a stream, from baselines that are known when it starts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.operators.anomaly import KEY, ema_anomaly, ema_baselines
from meterflow.schema import EMA_ALPHA, EMA_THRESHOLD
from meterflow.streaming.state import Kept

READING = (
    "event_id string, meter_id string, zone_id string, reading_ts timestamp_ntz, "
    "kwh_delta double, voltage double, power_kw double, power_factor double, "
    "frequency_hz double, meter_state string, arrival_seq long"
)
FLAGGED = f"{READING}, is_anomaly_ema boolean, ema_baseline double"
COLUMNS = [field.split()[0] for field in READING.split(", ")]
ORDER = ("reading_ts", "arrival_seq")


def baselines(path: str) -> Kept:
    """The baselines of meters and hours between the micro-batches of a stream."""
    return Kept(path, "meter_id string, ema_hour int, ema_baseline double", KEY)


def flag_batch(
    batch: DataFrame, kept: Kept, batch_id: int, alpha: float = EMA_ALPHA, threshold: float = EMA_THRESHOLD,
) -> DataFrame:
    """The readings of a micro-batch with their flags, run in time order from the baselines kept."""
    spark = batch.sparkSession
    touched = batch.select("meter_id", F.hour("reading_ts").alias("ema_hour")).distinct()
    known = kept.before(spark, batch_id).join(touched, KEY, "left_semi")
    return ema_anomaly(batch.select(*COLUMNS), alpha, threshold, known, ORDER)


def keep_baselines(flagged: DataFrame, kept: Kept, batch_id: int) -> None:
    """Keep what the average of each meter and hour of a flagged batch ended in."""
    kept.put(ema_baselines(flagged.filter(F.col("ema_baseline").isNotNull()), ORDER), batch_id)


def start_ema_anomaly(
    stream: DataFrame, path: str, checkpoint: str, seed: DataFrame | None = None,
    alpha: float = EMA_ALPHA, threshold: float = EMA_THRESHOLD, **trigger,
) -> StreamingQuery:
    """Log each reading of a stream with its flag, a folder for each micro-batch.

    `seed` holds the baselines with which a new stream begins, as `ema_baselines` of
    earlier loads gives them. Readings of a micro-batch run in time order; a reading
    without energy passes unflagged. Spark sorts the readings and a meter that has a
    large share of them runs in stretches, so no group is held in memory.
    """
    kept = baselines(f"{path}-baselines")
    kept.seed(stream.sparkSession, seed)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        flag_batch(batch, kept, batch_id, alpha, threshold).write.mode("overwrite").parquet(folder)
        keep_baselines(batch.sparkSession.read.schema(FLAGGED).parquet(folder), kept, batch_id)

    return (
        stream.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
