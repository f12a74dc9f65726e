"""Five-minute zone windows and what is derived from them."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.meters import by_value
from meterflow.functions.numbers import round_half_up, sum_kwh
from meterflow.functions.times import check_window, floor_window, seconds_interval
from meterflow.operators.ordered import running_by_slot
from meterflow.schema import EXPECTED_PER_ZONE, WINDOW_SECONDS, ZONE_AGG_SCHEMA, ZONES

Expected = DataFrame | Mapping[str, int] | int | None


def zone_window_agg(
    df: DataFrame, seconds: int = WINDOW_SECONDS, expected: Expected = None,
    late: str = "event", order: Sequence[str] = ("arrival", "arrival_seq"),
    anomaly: str | None = None,
) -> DataFrame:
    """Measures per zone and tumbling window.

    `late="event"` counts a late reading in the window of its own time.
    `late="arrival"` counts it in the window that is open in its zone when it
    arrives, in `order`. `expected` (meters per zone) adds the silent count,
    `anomaly` (a boolean column) the anomaly count.
    """
    if late == "arrival":
        placed = _open_window(df, seconds, order)
    else:
        placed = df.withColumn("window_start_ts", floor_window(F.col("reading_ts"), seconds))
    counts = [F.count_if(F.col(anomaly)).alias("anomaly_count")] if anomaly else []
    windows = placed.groupBy("zone_id", "window_start_ts").agg(
        sum_kwh(F.col("kwh_delta")).alias("total_kwh"),
        round_half_up(F.avg("power_kw"), 3).alias("avg_power_kw"),
        round_half_up(F.greatest(F.lit(0.0), F.max("power_kw")), 3).alias("peak_power_kw"),
        round_half_up(F.avg("power_factor"), 3).alias("avg_power_factor"),
        round_half_up(F.avg("voltage"), 2).alias("avg_voltage"),
        round_half_up(F.avg("frequency_hz"), 3).alias("avg_frequency_hz"),
        F.count_distinct("meter_id").alias("active_meter_count"),
        F.count_if(F.col("meter_state") == "degraded").alias("degraded_count"),
        F.count_if(F.col("meter_state") == "fault").alias("fault_count"),
        *counts,
    )
    ended = windows.withColumn("window_end_ts", F.col("window_start_ts") + seconds_interval(seconds))
    return in_window_order(ended if expected is None else with_silent(ended, expected))


def anomaly_counts(flagged: DataFrame, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Flagged readings per zone and window, for the windows that have any.

    Joining these to the windows keeps the other measures out of the Python
    pass that finds the flags.
    """
    start = floor_window(F.col("reading_ts"), seconds).alias("window_start_ts")
    return flagged.filter("is_anomaly_ema").groupBy("zone_id", start).agg(
        F.count("*").alias("anomaly_count"))


#: Distinct counts of merged sketches are off by 1.04 / sqrt(2 ** SKETCH_BITS), 1.6 %, as a standard error.
SKETCH_BITS = 12


def meter_sketches(df: DataFrame, seconds: int = WINDOW_SECONDS, bits: int = SKETCH_BITS) -> DataFrame:
    """A mergeable sketch of the active meters per zone and window, beside their exact number.

    Exact counts of windows can't be added up, since a meter is in many of them. Sketches can be kept
    with the windows and merged for any set of them (`merged_meters`) without the readings.
    NULL meters are in neither; a window without other meters has a NULL sketch.
    """
    start = floor_window(F.col("reading_ts"), seconds).alias("window_start_ts")
    meters = df.groupBy("zone_id", start, "meter_id").agg(F.count("*").alias("_n"))
    sketch = F.hll_sketch_agg("meter_id", F.lit(bits))
    return meters.groupBy("zone_id", "window_start_ts").agg(
        F.count("meter_id").alias("active_meter_count"),
        F.when(F.count("meter_id") > 0, sketch).alias("meters_sketch"))


def merged_meters(sketches: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct meters of all sketches, or per group of `by`; 0 where there is no meter."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("meters_sketch"))
    return sketches.groupBy(*by).agg(F.coalesce(merged, F.lit(0)).alias("meters"))


def in_window_order(windows: DataFrame) -> DataFrame:
    """The window columns that exist, in the order of the window schema."""
    return windows.select(*[c for c in ZONE_AGG_SCHEMA.names if c in windows.columns])


def with_silent(windows: DataFrame, expected: Expected) -> DataFrame:
    """Add `silent_meter_count`: expected meters that were not active, at least 0."""
    named = with_expected(windows, expected)
    silent = F.greatest(F.lit(0), F.col("_n") - F.col("active_meter_count")).cast("bigint")
    return named.withColumn("silent_meter_count", silent).drop("_n")


def with_expected(windows: DataFrame, expected: Expected) -> DataFrame:
    """Add `_n`, the expected meters of the zone, 100 where `expected` does not name it."""
    if not isinstance(expected, DataFrame):
        return windows.withColumn("_n", expected_count(F.col("zone_id"), expected))
    counts = expected.select("zone_id", F.col("n").alias("_n"))
    return windows.join(counts, "zone_id", "left").withColumn(
        "_n", F.coalesce("_n", F.lit(EXPECTED_PER_ZONE)))


def expected_count(zone_id: Column, expected: Mapping[str, int] | int) -> Column:
    """Expected meters of a zone, 100 for a zone that `expected` does not name."""
    if isinstance(expected, int):
        return F.lit(expected)
    return F.coalesce(by_value(zone_id, expected), F.lit(EXPECTED_PER_ZONE))


def expected_meters(df: DataFrame) -> DataFrame:
    """Distinct meters per zone, as `zone_id, n`."""
    return df.groupBy("zone_id").agg(F.count_distinct("meter_id").alias("n"))


def split_meters(total: Column, zones: Sequence[str] = ZONES) -> Column:
    """A fleet of `total` meters over `zones` as an array of structs; the first get the remainder."""
    z = len(zones)
    shares = [
        F.struct(F.lit(name).alias("zone_id"),
                 (F.floor(total / z) + (total % z > i).cast("int")).cast("bigint").alias("n"))
        for i, name in enumerate(zones)
    ]
    return F.array(*shares)


def with_demand_delta(windows: DataFrame) -> DataFrame:
    """Add the change in percent to the previous window of the zone that has readings."""
    previous = F.lag("total_kwh").over(Window.partitionBy("zone_id").orderBy("window_start_ts"))
    change = (F.col("total_kwh") - F.col("_prev")) / F.col("_prev") * 100.0
    return (
        windows.withColumn("_prev", previous)
        .withColumn("demand_vs_prev_window_pct", F.when(F.col("_prev") > 0, round_half_up(change, 2)))
        .drop("_prev")
    )


def slot_grid(bounds: DataFrame, seconds: int) -> DataFrame:
    """`zone_id, slot`: every slot from `lo` to `hi` for each of `zones`, from a row that has these three."""
    check_window(seconds)
    day = F.expr("INTERVAL 1 DAY")
    days = F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"), day)
    in_day = F.transform(
        F.sequence(F.lit(0), F.lit(86400 - seconds), F.lit(seconds)),
        lambda s: F.col("d").cast("timestamp_ntz") + seconds_interval(s),
    )
    return (
        bounds.filter(F.col("lo").isNotNull())
        .select("lo", "hi", "zones", F.explode(days).alias("d"))
        .select("lo", "hi", "d", F.explode("zones").alias("zone_id"))
        .select("lo", "hi", "zone_id", F.explode(in_day).alias("slot"))
        .filter(F.col("slot").between(F.col("lo"), F.col("hi")))
        .select("zone_id", "slot")
    )


def fill_window_grid(
    windows: DataFrame, zones: Sequence[str] = ZONES, seconds: int = WINDOW_SECONDS,
    expected: Expected = EXPECTED_PER_ZONE,
) -> DataFrame:
    """Every slot between the first and last window, for `zones` and any other zone of the windows."""
    every = F.array_union(F.collect_set("zone_id"), F.array(*map(F.lit, zones)))
    bounds = windows.agg(F.min("window_start_ts").alias("lo"), F.max("window_start_ts").alias("hi"),
                         every.alias("zones"))
    grid = slot_grid(bounds, seconds).withColumnRenamed("slot", "window_start_ts")
    measured = windows.select("zone_id", "window_start_ts", "total_kwh", "active_meter_count")
    joined = grid.join(measured, ["zone_id", "window_start_ts"], "left")
    filled = joined.select(
        "zone_id", "window_start_ts",
        F.coalesce("total_kwh", F.lit(0.0)).alias("total_kwh"),
        F.coalesce("active_meter_count", F.lit(0)).alias("active_meter_count"),
        F.col("active_meter_count").isNull().alias("is_empty"),
    )
    return with_silent(filled, expected).select(
        "zone_id", "window_start_ts", "total_kwh", "active_meter_count", "silent_meter_count", "is_empty")


def zone_outages(
    windows: DataFrame, seconds: int = WINDOW_SECONDS, expected: Expected = EXPECTED_PER_ZONE,
    ratio: float = 0.70, zones: Sequence[str] = ZONES,
) -> DataFrame:
    """Slots in which at least `ratio` of the expected meters were silent, those without a reading included."""
    share = F.col("silent_meter_count") / F.nullif(
        F.col("silent_meter_count") + F.col("active_meter_count"), F.lit(0))
    filled = fill_window_grid(windows, zones, seconds, expected)
    return filled.withColumn("silent_ratio", round_half_up(share, 4)).filter(share >= ratio)


def status_label() -> Column:
    """Status of a window; silent meters outrank faults."""
    return (
        F.when(F.col("silent_meter_count") > 3, "SILENT METERS")
        .when(F.col("fault_count") > 0, "FAULTS")
        .otherwise("OK")
    )


def _open_window(df: DataFrame, seconds: int, order: Sequence[str]) -> DataFrame:
    """Add the window that is open in the zone when a reading arrives.

    That is the latest window start seen so far. Stretches of a million
    arrivals are run through side by side.
    """
    placed = df.withColumn("_own", floor_window(F.col("reading_ts"), seconds))
    slot = F.floor(F.col(order[0]) / ARRIVALS_PER_SLOT)
    opened = running_by_slot(placed, ["zone_id"], order, slot, "_own", "window_start_ts", how="max")
    return opened.drop("_own")


ARRIVALS_PER_SLOT = 1_000_000
