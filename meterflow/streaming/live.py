"""The live path in one stream query: messages, dead letters, copies, flags, window parts, closed windows, push rows."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterflow.functions.times import check_window, floor_window, seconds_interval
from meterflow.operators.routing import to_push_rows
from meterflow.operators.windows import Expected, in_window_order, with_demand_delta, with_silent
from meterflow.schema import EXPECTED_PER_ZONE, WINDOW_SECONDS
from meterflow.streaming.anomaly import COLUMNS, FLAGGED, baselines, flag_batch, keep_baselines
from meterflow.streaming.sources import check_messages, zone_key
from meterflow.streaming.state import DayLog, Kept
from meterflow.streaming.windows import PART_SCHEMA, merged_parts, window_parts, windows_of_parts

#: Counts of a micro-batch, for each zone; a message that can't be used has none.
ACCOUNT = "zone_id string, messages long, dead long, copies long, accepted long, late long"


@dataclass
class LiveTables:
    """The tables below the folder of a live path."""

    out: str

    def __post_init__(self):
        self.flags = DayLog(f"{self.out}/flags", FLAGGED, "reading_ts")
        self.parts = DayLog(f"{self.out}/parts", PART_SCHEMA, "window_start_ts")
        self.baselines = baselines(f"{self.out}/state/baselines")
        #: how far a zone has come: its newest reading, and the energy of its last closed window
        self.zones = Kept(f"{self.out}/state/zones", "zone_id string, clock timestamp_ntz, closed_kwh double", ["zone_id"])
        #: the last window of each zone and hour
        self.last = Kept(f"{self.out}/state/last", "zone_id string, hour timestamp_ntz, window_start_ts timestamp_ntz, "
                         "total_kwh double", ["zone_id", "hour"])

    def seed(self, spark: SparkSession, known: DataFrame | None) -> None:
        for table in (self.flags, self.parts, self.zones, self.last):
            table.seed(spark)
        self.baselines.seed(spark, known)


def run_live(
    messages: DataFrame, out: str, checkpoint: str, seconds: int = WINDOW_SECONDS,
    deliver: Callable[[DataFrame, int], None] | None = None, expected: Expected = EXPECTED_PER_ZONE,
    seed: DataFrame | None = None, delay: int = 0, **trigger,
) -> StreamingQuery:
    """Check, flag and aggregate messages, and hand the windows they touch to `deliver`.

    Below `out` come, with a folder for each micro-batch:

    - `dead`: unusable messages and the reason; those that come without a `key` get their zone;
    - `flags`: each reading once, with its anomaly flag. A message delivered again, in the same
      batch or any later one, is a copy if a reading of its id and hour is there. The average
      begins in the baselines of `seed`;
    - `parts`: sums per zone, window and meter. A reading counts in its window however late it is;
    - `closed`: windows with the change in percent to the one closed before, each given out once.
      A zone closes them by its own readings, when one is `delay` seconds beyond the end, so a
      zone that is behind the others loses nothing. Readings of a window closed before are late:
      they are in `flags` and `parts`, not in `closed`;
    - `accounts`: for each zone, how many messages were dead, copies, accepted, and late of these.

    A batch that runs again replaces its folders, and no other stream reads them, so nothing is lost
    and nothing counts twice. `trigger` defaults to all that is available.
    """
    check_window(seconds)
    tables = LiveTables(out)
    tables.seed(messages.sparkSession, seed)
    checked = check_messages(messages, COLUMNS)
    # of a usable message a hash stands for its text, and only the fields that flags and parts need are kept
    unusable = F.col("reason").isNotNull()
    own = {} if "key" in messages.columns else {"key": zone_key()}
    own.update({c: F.col(c) for c in messages.columns})
    came = [F.when(unusable, value).alias(c) for c, value in own.items()]
    slim = checked.select(*came, "reason", *COLUMNS, F.xxhash64("value").alias("_text"))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        dead = batch.filter(F.col("reason").isNotNull()).select(*own, "reason")
        dead.write.mode("overwrite").parquet(f"{out}/dead/batch_id={batch_id}")
        usable = batch.filter(F.col("reason").isNull())
        fresh = _without_copies(spark, usable, tables.flags, batch_id).persist()  # flags read it several times
        flagged = tables.flags.write(flag_batch(fresh, tables.baselines, batch_id), batch_id)
        fresh.unpersist()
        keep_baselines(flagged, tables.baselines, batch_id)
        tables.flags.publish(spark, batch_id)
        tables.parts.write(window_parts(flagged, seconds, "is_anomaly_ema"), batch_id)
        tables.parts.publish(spark, batch_id, merged_parts)
        known = tables.zones.before(spark, batch_id)
        _account(batch, flagged, known, seconds, delay).write.mode("overwrite").parquet(f"{out}/accounts/batch_id={batch_id}")
        batch.unpersist()
        closed = _closed(spark, tables, flagged, known, batch_id, seconds, delay, expected)
        closed.write.mode("overwrite").parquet(f"{out}/closed/batch_id={batch_id}")
        _advance(spark, tables, flagged, known, f"{out}/closed/batch_id={batch_id}", batch_id)
        touched = _touched(spark, tables, batch_id, seconds, expected)
        if deliver is not None:
            deliver(touched, batch_id)

    return (
        slim.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def read_live_windows(
    spark: SparkSession, out: str, batch_id: int, hours: DataFrame, seconds: int = WINDOW_SECONDS,
    expected: Expected = EXPECTED_PER_ZONE,
) -> DataFrame:
    """The windows of some hours (`hour`) after a micro-batch; opens the folders of their days only."""
    parts = LiveTables(out).parts.read(spark, batch_id + 1, hours).withColumn("hour", F.date_trunc("hour", "window_start_ts").cast("timestamp_ntz"))
    parts = parts.join(hours.select("hour").distinct(), "hour", "left_semi").drop("hour")
    return in_window_order(with_silent(windows_of_parts(parts, seconds, True), expected))


def _hours(rows: DataFrame, ts: str) -> DataFrame:
    return rows.select(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).distinct()


def _without_copies(spark: SparkSession, usable: DataFrame, flags: DayLog, batch_id: int) -> DataFrame:
    """The first of the readings of an id and hour, if no batch before had it. Without an id none is a copy."""
    place = F.coalesce("event_id", F.col("_text").cast("string"))
    hour = F.date_trunc("hour", "reading_ts")
    same = Window.partitionBy(place, F.col("event_id").isNull(), hour).orderBy("reading_ts", "arrival_seq", "_text")
    numbered = usable.select(*COLUMNS, "_text").withColumn("_copy", F.row_number().over(same))
    once = numbered.filter("_copy = 1 OR event_id IS NULL").select(*COLUMNS)
    seen = flags.read(spark, batch_id, _hours(usable, "reading_ts")).select(
        F.col("event_id").alias("_id"), F.date_trunc("hour", "reading_ts").alias("_at"))
    return once.join(seen, (F.col("event_id") == F.col("_id")) & (hour == F.col("_at")), "left_anti")


def _end(seconds: int, delay: int = 0) -> Column:
    return F.col("window_start_ts") + seconds_interval(seconds + delay)


def _account(batch: DataFrame, flagged: DataFrame, known: DataFrame, seconds: int, delay: int) -> DataFrame:
    """Counts of a batch: messages = dead + copies + accepted in every zone, and late <= accepted."""
    came = batch.groupBy(F.when(F.col("reason").isNull(), F.col("zone_id")).alias("zone_id")).agg(
        F.count("*").alias("messages"), F.count("reason").alias("dead"))
    starts = flagged.select("zone_id", floor_window(F.col("reading_ts"), seconds).alias("window_start_ts"))
    late = F.coalesce(_end(seconds, delay) <= F.col("clock"), F.lit(False))
    took = starts.join(known.select("zone_id", "clock"), "zone_id", "left").groupBy("zone_id").agg(
        F.count("*").alias("accepted"), F.count_if(late).alias("late"))
    zone = came["zone_id"].eqNullSafe(took["zone_id"])
    counted = came.join(took, zone, "left").select(
        came["zone_id"], "messages", "dead", F.coalesce("accepted", F.lit(0)).cast("long").alias("accepted"),
        F.coalesce("late", F.lit(0)).cast("long").alias("late"))
    return counted.withColumn("copies", F.col("messages") - F.col("dead") - F.col("accepted")).select(
        *[f.split()[0] for f in ACCOUNT.split(", ")])


def _closed(
    spark: SparkSession, tables: LiveTables, flagged: DataFrame, known: DataFrame, batch_id: int,
    seconds: int, delay: int, expected: Expected,
) -> DataFrame:
    """The windows that the zones' clocks pass in this batch, with the change to the one before."""
    newest = flagged.groupBy("zone_id").agg(F.max("reading_ts").alias("now"), F.min("reading_ts").alias("first"))
    moved = newest.join(known, "zone_id", "left")
    # a zone's first windows are all of this batch; others may go back to the one that its clock is in
    first = F.coalesce(F.col("clock") - seconds_interval(seconds + delay), F.col("first"))
    span = moved.agg(F.min(first).alias("lo"), F.max("now").alias("hi")).first()
    parts = tables.parts.read_between(spark, batch_id + 1, span.lo, span.hi)
    due = (_end(seconds, delay) <= F.col("now")) & (F.col("clock").isNull() | (_end(seconds, delay) > F.col("clock")))
    own = parts.join(moved, "zone_id").filter(due).select(parts.columns)
    windows = with_silent(windows_of_parts(own, seconds, True), expected)
    before = known.filter(F.col("closed_kwh").isNotNull()).select(
        "zone_id", F.lit("0001-01-01").cast("timestamp_ntz").alias("window_start_ts"), F.col("closed_kwh").alias("total_kwh"))
    chained = with_demand_delta(windows.unionByName(before, allowMissingColumns=True))
    return in_window_order(chained.filter(F.col("window_end_ts").isNotNull()))


def _advance(spark: SparkSession, tables: LiveTables, flagged: DataFrame, known: DataFrame, closed: str, batch_id: int) -> None:
    newest = flagged.groupBy("zone_id").agg(F.max("reading_ts").alias("now"))
    last = spark.read.parquet(closed).groupBy("zone_id").agg(F.max_by("total_kwh", "window_start_ts").alias("last_kwh"))
    changed = newest.join(known, "zone_id", "left").join(last, "zone_id", "left")
    tables.zones.put(changed.select("zone_id", F.greatest("clock", "now").alias("clock"),
                                    F.coalesce("last_kwh", "closed_kwh").alias("closed_kwh")), batch_id)


def _touched(spark: SparkSession, tables: LiveTables, batch_id: int, seconds: int, expected: Expected) -> DataFrame:
    """Push rows of the windows that a micro-batch has readings of, with the change to the window before.

    Only the hours touched are read; of the others, the last window of each zone is kept.
    """
    own = tables.parts.of_batch(spark, batch_id).select("zone_id", "window_start_ts").distinct()
    hours = _hours(own, "window_start_ts")
    parts = tables.parts.read(spark, batch_id + 1, hours).withColumn("hour", F.date_trunc("hour", "window_start_ts").cast("timestamp_ntz"))
    near = with_silent(windows_of_parts(parts.join(hours, "hour", "left_semi").drop("hour"), seconds, True), expected)
    hour = F.date_trunc("hour", "window_start_ts").cast("timestamp_ntz").alias("hour")
    latest = F.max(F.struct("window_start_ts", "total_kwh")).alias("_l")
    before = tables.last.before(spark, batch_id).join(hours, "hour", "left_anti").drop("hour")
    tables.last.put(near.groupBy("zone_id", hour).agg(latest).select("zone_id", "hour", "_l.*"), batch_id)
    chained = with_demand_delta(near.unionByName(before, allowMissingColumns=True))
    return to_push_rows(in_window_order(chained.join(own, ["zone_id", "window_start_ts"], "left_semi")))
