"""Dashboard queries over marts and windows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.numbers import percent, round_half_up, sum_kwh
from meterflow.schema import CUSTOMER_TYPES


def kpi_overview(zone_daily: DataFrame) -> DataFrame:
    return zone_daily.agg(
        sum_kwh(F.col("total_kwh")).alias("total_kwh"),
        round_half_up(F.avg("peak_power_kw"), 3).alias("avg_daily_peak_kw"),
        round_half_up(F.avg("uptime_pct"), 2).alias("avg_uptime_pct"),
    )


def kpi_faults(faults: DataFrame) -> DataFrame:
    return faults.agg(
        F.sum("degraded_reading_count").alias("degraded_events"),
        F.sum("fault_reading_count").alias("fault_events"),
        F.sum("silent_reading_count").alias("silent_events"),
        F.sum("total_fault_readings").alias("all_fault_events"),
    )


def peak_hour_by_zone(heatmap: DataFrame) -> DataFrame:
    """The cell with the highest mean per zone; ties go to the lowest day, then hour."""
    best = Window.partitionBy("zone_id").orderBy(
        F.desc("avg_kwh"), "day_of_week_num", "hour_of_day")
    return (
        heatmap.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1")
        .select("zone_id", "day_of_week_num", "hour_of_day", F.col("avg_kwh").alias("peak_avg_kwh"))
    )


def overnight_trough(heatmap: DataFrame) -> DataFrame:
    """Demand per zone in the hours 0 to 5."""
    return heatmap.filter(F.col("hour_of_day").between(0, 5)).groupBy("zone_id").agg(
        sum_kwh(F.col("total_kwh")).alias("total_kwh"),
        F.min("avg_kwh").alias("lowest_avg_kwh"),
        F.sum("reading_count").alias("reading_count"),
    )


def heatmap_matrix(heatmap: DataFrame) -> DataFrame:
    """Day of week by hour of day, the mean reading over all zones."""
    cell = round_half_up(sum_kwh(F.col("total_kwh")) / F.sum("reading_count"), 4)
    wide = heatmap.groupBy("day_of_week_num").pivot("hour_of_day", list(range(24))).agg(cell)
    return wide.select("day_of_week_num", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])


def last_days(zone_daily: DataFrame, days: int) -> DataFrame:
    """Rows of the last `days` days up to the latest date."""
    latest = zone_daily.agg(F.max("reading_date")).scalar()
    return zone_daily.filter(F.col("reading_date") > latest - F.make_dt_interval(F.lit(days)))


def daily_trend(zone_daily: DataFrame, days: int = 14) -> DataFrame:
    return last_days(zone_daily, days).groupBy("reading_date").agg(
        sum_kwh(F.col("total_kwh")).alias("total_kwh"))


def zone_totals(zone_daily: DataFrame, days: int = 30) -> DataFrame:
    return last_days(zone_daily, days).groupBy("zone_id").agg(
        sum_kwh(F.col("total_kwh")).alias("total_kwh"))


def faults_by_zone(faults: DataFrame) -> DataFrame:
    return faults.groupBy("zone_id").agg(
        F.sum("total_fault_readings").alias("total_fault_readings"))


def most_faulty_zone(faults: DataFrame) -> DataFrame:
    return faults_by_zone(faults).orderBy(F.desc("total_fault_readings"), "zone_id").limit(1)


def latest_window(windows: DataFrame) -> DataFrame:
    """The rows of the latest window start over all zones."""
    latest = windows.agg(F.max("window_start_ts")).scalar()
    return windows.filter(F.col("window_start_ts") == latest)


def latest_window_ranked(windows: DataFrame) -> DataFrame:
    """Zones of the latest window ranked by demand."""
    by_demand = Window.partitionBy("window_start_ts").orderBy(F.desc("total_kwh"), "zone_id")
    return latest_window(windows).select(
        "zone_id", "window_start_ts", "total_kwh",
        F.row_number().over(by_demand).alias("demand_rank"))


def last_windows(windows: DataFrame, n: int = 6) -> DataFrame:
    """The last `n` windows of every zone."""
    newest = Window.partitionBy("zone_id").orderBy(F.desc("window_start_ts"))
    return windows.withColumn("_rank", F.row_number().over(newest)).filter(
        F.col("_rank") <= n).drop("_rank")


def live_kpis(windows: DataFrame) -> DataFrame:
    """The live cards over the latest window."""
    return latest_window(windows).agg(
        sum_kwh(F.col("total_kwh")).alias("total_demand_kwh"),
        round_half_up(F.avg("avg_power_factor"), 3).alias("avg_power_factor"),
        round_half_up(F.avg("avg_frequency_hz"), 3).alias("avg_frequency_hz"),
        F.sum("fault_count").alias("open_fault_alerts"),
        F.sum("active_meter_count").alias("active_meters"),
        F.sum("silent_meter_count").alias("silent_meters"),
        F.sum("anomaly_count").alias("anomalous_readings"),
        F.min_by("zone_id", F.struct(-F.col("total_kwh"), "zone_id")).alias("peak_zone"),
    )


def fleet_status_states(stg: DataFrame) -> DataFrame:
    """Readings per meter state and their share of all readings."""
    states = stg.groupBy("meter_state").agg(F.count("*").alias("reading_count"))
    everything = Window.partitionBy(F.lit(1))  # over the few state rows only
    share = percent(F.col("reading_count"), F.sum("reading_count").over(everything), 1)
    return states.withColumn("share_pct", share)


def fleet_status_zone_kwh(stg: DataFrame) -> DataFrame:
    return stg.groupBy("zone_id").agg(sum_kwh(F.col("kwh_delta")).alias("total_kwh"))


def fleet_status_totals(stg: DataFrame) -> DataFrame:
    return stg.agg(
        F.count("*").alias("events"),
        F.count_if("is_anomaly").alias("anomalous_readings"),
        F.count_if(F.col("event_type") == "alert").alias("alert_events"),
        F.count_if("is_silent").alias("silent_cycles"),
    )


def fleet_composition(stg: DataFrame, types: Sequence[str] = CUSTOMER_TYPES) -> DataFrame:
    """Meters per zone and customer type; `total` also has meters of another or no type."""
    of_type = [F.max(F.coalesce(F.col("customer_type") == t, F.lit(False))).alias(t) for t in types]
    meters = stg.filter(F.col("meter_id").isNotNull()).groupBy("zone_id", "meter_id").agg(*of_type)
    counts = [F.count_if(F.col(t)).alias(t) for t in types]
    return meters.groupBy("zone_id").agg(*counts, F.count("*").alias("total"))
