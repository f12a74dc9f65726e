"""Alarms of meters that have gone silent, while they are."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from meterflow.functions.meters import interval_seconds
from meterflow.functions.times import as_instant, as_wall_time
from meterflow.streaming.sinks import start_log

ALARM = "meter_id string, zone_id string, from_us long"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_silence_alarms(
    stream: DataFrame, path: str, checkpoint: str, k: int = 3, delay: str = "0 seconds", seed: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Log an alarm (meter_id, zone_id, silent_from) for each pause longer than `k` reading intervals.

    It is given out when the stream's newest reading, less `delay`, is beyond the pause's limit:
    a timer of the meter fires then, with no reading of its own. Each pause has one alarm, over restarts
    too. Readings that come later than `delay` are not seen. A new stream may know the last readings
    of earlier loads (`seed`: meter_id, zone_id, customer_type, reading_ts). State is a row for each
    meter, in RocksDB; of a micro-batch, a meter's times are held at once, 8 bytes each.
    """
    spark = stream.sparkSession

    def fed(rows: DataFrame) -> DataFrame:
        return rows.select("meter_id", "zone_id", as_instant(F.col("reading_ts")).alias("at"),
                           (k * interval_seconds(F.col("customer_type")) * 1_000_000).cast("long").alias("limit_us"))

    known = None
    if seed is not None:
        last = fed(seed).groupBy("meter_id").agg(F.max_by(F.struct("zone_id", "at", "limit_us"), "at").alias("l"))
        known = last.select("meter_id", "l.*").groupBy("meter_id")
    alarms = fed(stream).withWatermark("at", delay).groupBy("meter_id").transformWithStateInPandas(
        statefulProcessor=Silence(), outputStructType=ALARM, outputMode="Append", timeMode="EventTime", initialState=known)
    told = alarms.select("meter_id", "zone_id", as_wall_time(F.timestamp_micros("from_us")).alias("silent_from"))
    before = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ROCKS)  # the only store with timers; a query keeps what it was started with
    try:
        return start_log(told, path, checkpoint, **trigger)
    finally:
        spark.conf.set(_STORE, before)


class Silence(StatefulProcessor):
    """Keeps the last reading of a meter, and whether its silence since has been told."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at_us long, zone_id string, limit_us long, told boolean")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        row = initialState.iloc[0]
        self._keep(_micros(row["at"]), row["zone_id"], int(row["limit_us"]), False)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        times, limits, zone = [], [], None
        for some in rows:
            times.append(some["at"].to_numpy().astype("datetime64[us]").astype(np.int64))
            limits.append(some["limit_us"].to_numpy(dtype=np.int64))
            zone = some["zone_id"].iloc[-1]
        at, limit = np.concatenate(times), np.concatenate(limits)
        order = np.argsort(at, kind="stable")
        at, limit, told = at[order], limit[order], False
        if self.last.exists():
            before, _, kept, told = self.last.get()
            if before >= at[-1]:  # all of them came out of order
                return
            newer = at > before
            at, limit = np.append(before, at[newer]), np.append(kept, limit[newer])
        # a pause is measured by the interval of the reading that ends it, as in a batch
        pause = np.flatnonzero(np.diff(at) > limit[1:])
        if told:
            pause = pause[pause > 0]
        self._keep(int(at[-1]), zone, int(limit[-1]), told and len(at) == 1)
        if len(pause):
            yield _alarms(key[0], zone, at[pause])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, zone, limit, told = self.last.get()
        if not told:
            self.last.update((at, zone, limit, True))
            yield _alarms(key[0], zone, [at])

    def _keep(self, at: int, zone: str, limit: int, told: bool) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.last.update((at, zone, limit, told))
        self.handle.registerTimer((at + limit) // 1000 + 1)

    def close(self) -> None:
        pass


def _micros(at: pd.Timestamp) -> int:
    return int(np.datetime64(at, "us").astype(np.int64))


def _alarms(meter: str, zone: str, at) -> pd.DataFrame:
    return pd.DataFrame({"meter_id": meter, "zone_id": zone, "from_us": np.asarray(at, np.int64)})
