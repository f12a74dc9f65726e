"""Marts over the staging view."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.numbers import kwh_units, percent, round_half_up, sum_kwh
from meterflow.schema import EXPECTED_PER_ZONE

#: What the marts that are added up from `zone_partials` group by.
PARTIAL_KEYS = ["zone_id", "customer_type", "reading_date", "hour_of_day", "day_of_week_num", "day_of_week_name", "is_weekend"]


def mart_demand_heatmap(stg: DataFrame) -> DataFrame:
    """Demand per zone, hour of day and day of week."""
    keys = ["zone_id", "hour_of_day", "day_of_week_num", "day_of_week_name", "is_weekend"]
    return stg.groupBy(*keys).agg(
        round_half_up(F.avg("kwh_delta"), 4).alias("avg_kwh"),
        sum_kwh(F.col("kwh_delta")).alias("total_kwh"),
        F.count("*").alias("reading_count"),
    ).orderBy("zone_id", "day_of_week_num", "hour_of_day")


def mart_zone_daily(stg: DataFrame, expected_per_zone: int = EXPECTED_PER_ZONE) -> DataFrame:
    """Consumption, fleet and uptime per zone and day.

    Readings are first reduced per meter, so both distinct counts become plain
    counts of meter rows; a distinct count of each would double every reading.
    """
    meters = stg.groupBy("zone_id", "reading_date", "meter_id").agg(
        sum_kwh(F.col("kwh_delta")).alias("kwh"),
        F.sum("power_kw").alias("kw_sum"),
        F.count("power_kw").alias("kw_count"),
        F.max("power_kw").alias("kw_max"),
        F.max(F.col("is_silent").cast("int")).alias("was_silent"),
    )
    return _zone_daily(meters, expected_per_zone)


def _zone_daily(meters: DataFrame, expected_per_zone: int) -> DataFrame:
    daily = meters.groupBy("zone_id", "reading_date").agg(
        sum_kwh(F.col("kwh")).alias("total_kwh"),
        round_half_up(F.sum("kw_sum") / F.nullif(F.sum("kw_count"), F.lit(0)), 3)
        .alias("avg_power_kw"),
        F.round(F.max("kw_max"), 3).alias("peak_power_kw"),
        F.count("meter_id").alias("active_meter_count"),
        F.count_if((F.col("was_silent") == 1) & F.col("meter_id").isNotNull())
        .alias("silent_meter_count"),
    )
    uptime = percent(F.col("active_meter_count"), F.lit(expected_per_zone))
    return daily.withColumn("uptime_pct", uptime).orderBy("zone_id", "reading_date")


def _unwell() -> Column:
    return F.col("is_degraded") | F.col("is_fault") | F.col("is_silent")


def mart_fault_summary(stg: DataFrame) -> DataFrame:
    """Readings outside the normal state per zone and day."""
    return stg.groupBy("zone_id", "reading_date").agg(
        F.count_if("is_degraded").alias("degraded_reading_count"),
        F.count_if("is_fault").alias("fault_reading_count"),
        F.count_if("is_silent").alias("silent_reading_count"),
        F.count_if(_unwell()).alias("total_fault_readings"),
    ).orderBy("zone_id", "reading_date")


def mart_customer_segment(stg: DataFrame) -> DataFrame:
    """Consumption per customer type."""
    return (
        stg.groupBy("customer_type").agg(sum_kwh(F.col("kwh_delta")).alias("total_kwh"))
        .orderBy(F.desc("total_kwh"))
    )


def zone_partials(stg: DataFrame, keys: Sequence[str], usable: Column, failed: Mapping[str, Column]) -> DataFrame:
    """Sums of the usable rows from which three marts and the checks can be added up, for any `keys` first.

    `failed` names the conditions of rows that fail a check. Rows that are not usable
    make groups too, of 0 readings.
    """
    def count(condition: Column) -> Column:
        return F.count_if(usable & condition)

    kwh = F.when(usable, F.col("kwh_delta"))
    return stg.groupBy(*keys, *PARTIAL_KEYS).agg(
        F.sum(kwh_units(kwh)).alias("units"), F.count(kwh).alias("kwh_count"), F.count_if(usable).alias("readings"),
        count(F.col("is_degraded")).alias("degraded"), count(F.col("is_fault")).alias("fault"),
        count(F.col("is_silent")).alias("silent"), count(_unwell()).alias("unwell"),
        *[count(c).alias(name) for name, c in failed.items()])


def meter_partials(stg: DataFrame, keys: Sequence[str], usable: Column) -> DataFrame:
    """Sums per zone, day and meter of the usable rows, from which the daily mart can be added up."""
    power = F.when(usable, F.col("power_kw"))
    return stg.groupBy(*keys, "zone_id", "reading_date", "meter_id").agg(
        F.sum(kwh_units(F.when(usable, F.col("kwh_delta")))).alias("units"), F.count_if(usable).alias("readings"),
        F.sum(power).alias("kw_sum"), F.count(power).alias("kw_count"), F.max(power).alias("kw_max"),
        F.max(F.when(usable, F.col("is_silent").cast("int"))).alias("was_silent"))


def marts_of_partials(zones: DataFrame) -> dict[str, DataFrame]:
    """The heatmap, the fault summary and the segments of `zone_partials`."""
    rows = zones.filter("readings > 0")
    total = (F.sum("units") / 10000.0).alias("total_kwh")
    average = F.sum("units") / 10000.0 / F.nullif(F.sum("kwh_count"), F.lit(0))
    heatmap = rows.groupBy("zone_id", "hour_of_day", "day_of_week_num", "day_of_week_name", "is_weekend").agg(
        round_half_up(average, 4).alias("avg_kwh"), total, F.sum("readings").alias("reading_count"))
    faults = rows.groupBy("zone_id", "reading_date").agg(
        F.sum("degraded").alias("degraded_reading_count"), F.sum("fault").alias("fault_reading_count"),
        F.sum("silent").alias("silent_reading_count"), F.sum("unwell").alias("total_fault_readings"))
    return {
        "mart_demand_heatmap": heatmap.orderBy("zone_id", "day_of_week_num", "hour_of_day"),
        "mart_fault_summary": faults.orderBy("zone_id", "reading_date"),
        "mart_customer_segment": rows.groupBy("customer_type").agg(total).orderBy(F.desc("total_kwh")),
    }


def zone_daily_of_partials(meters: DataFrame, expected_per_zone: int = EXPECTED_PER_ZONE) -> DataFrame:
    """The daily mart of `meter_partials`."""
    whole = meters.filter("readings > 0").groupBy("zone_id", "reading_date", "meter_id").agg(
        (F.sum("units") / 10000.0).alias("kwh"), F.sum("kw_sum").alias("kw_sum"), F.sum("kw_count").alias("kw_count"),
        F.max("kw_max").alias("kw_max"), F.max("was_silent").alias("was_silent"))
    return _zone_daily(whole, expected_per_zone)


def with_day_over_day(zone_daily: DataFrame) -> DataFrame:
    """Add the change in percent to the zone's previous day with readings."""
    before = F.lag("total_kwh").over(Window.partitionBy("zone_id").orderBy("reading_date"))
    change = (F.col("total_kwh") - F.col("_prev")) / F.col("_prev") * 100.0
    return (
        zone_daily.withColumn("_prev", before)
        .withColumn("day_over_day_pct", F.when(F.col("_prev") > 0, round_half_up(change, 2)))
        .drop("_prev")
    )


def meter_health_daily(stg: DataFrame) -> DataFrame:
    """Scorecard per meter and day: share of fault, silent and flagged readings."""
    n = F.count("*")
    return stg.groupBy("meter_id", "reading_date").agg(
        n.alias("reading_count"),
        percent(F.count_if("is_fault"), n).alias("fault_rate_pct"),
        percent(F.count_if("is_silent"), n).alias("silent_rate_pct"),
        percent(F.count_if("is_anomaly"), n).alias("anomaly_rate_pct"),
        percent(F.count_if("is_normal"), n).alias("health_score"),
    )


def segment_daily(stg: DataFrame) -> DataFrame:
    """Consumption, power factor and fault rate per customer type and day."""
    return stg.groupBy("customer_type", "reading_date").agg(
        sum_kwh(F.col("kwh_delta")).alias("total_kwh"),
        round_half_up(F.avg("power_factor"), 4).alias("avg_power_factor"),
        percent(F.count_if("is_fault"), F.count("*")).alias("fault_rate_pct"),
    )


def segment_weekend(stg: DataFrame) -> DataFrame:
    """Consumption per customer type on weekdays and weekends."""
    return stg.groupBy("customer_type", "is_weekend").agg(
        sum_kwh(F.col("kwh_delta")).alias("total_kwh"),
        round_half_up(F.avg("kwh_delta"), 4).alias("avg_kwh"),
        F.count("*").alias("reading_count"),
    )
