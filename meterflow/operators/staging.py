"""The staging view: typed readings with derived columns, one row per event."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.meters import voltage_deviation
from meterflow.functions.times import day_of_week, day_start, floor_window, hour_start
from meterflow.schema import LOW_POWER_FACTOR, READING_SCHEMA, WINDOW_SECONDS


def staging(
    raw: DataFrame, strict: bool = True, low_pf: float = LOW_POWER_FACTOR, keep: Sequence[str] = (),
) -> DataFrame:
    """Staging rows from raw rows (`src` variant, `load_ts`).

    A missing key gives NULL. A value of the wrong type raises when `strict`,
    and gives NULL otherwise. `keep` names further columns of `raw` to put last.
    """
    get = F.variant_get if strict else F.try_variant_get
    to_time = F.to_timestamp_ntz if strict else _try_time
    cols = []
    for field in READING_SCHEMA.fields:
        value = get(F.col("src"), f"$.{field.name}", field.dataType.simpleString())
        cols.append(_staged(field.name, value, to_time))
    return enrich(raw.select(*cols, "load_ts", *keep), low_pf)


def staging_from_text(raw: DataFrame, low_pf: float = LOW_POWER_FACTOR) -> DataFrame:
    """Staging rows from raw text (`value`, `load_ts`) read with the fixed schema.

    One pass of the JSON parser, only over the keys that are asked for, where
    the variant path builds a variant first. Values of the wrong type give NULL.
    """
    parsed = raw.withColumn("r", F.from_json("value", READING_SCHEMA))
    cols = [_staged(name, F.col(f"r.{name}"), _try_time) for name in READING_SCHEMA.names]
    return enrich(parsed.select(*cols, "load_ts"), low_pf)


def staging_from_readings(df: DataFrame, low_pf: float = LOW_POWER_FACTOR) -> DataFrame:
    """Staging rows from readings that are typed already, such as a Parquet archive."""
    return enrich(df.withColumnRenamed("frequency_hz", "grid_frequency_hz"), low_pf)


def enrich(parsed: DataFrame, low_pf: float = LOW_POWER_FACTOR) -> DataFrame:
    """Add the time buckets, calendar and state flags and electrical checks."""
    ts = F.col("reading_ts")
    dow = day_of_week(ts)
    return parsed.select(
        "*",
        hour_start(ts).alias("reading_hour"),
        day_start(ts).alias("reading_date"),
        floor_window(ts, WINDOW_SECONDS).alias("window_bucket"),
        F.hour(ts).alias("hour_of_day"),
        dow.alias("day_of_week_num"),
        F.dayname(ts.cast("date")).alias("day_of_week_name"),
        _flag(dow.isin(0, 6)).alias("is_weekend"),
        *[_flag(F.col("meter_state") == s).alias(f"is_{s}")
          for s in ("degraded", "fault", "silent", "normal")],
        _flag(F.col("power_factor") < low_pf).alias("is_low_power_factor"),
        voltage_deviation(F.col("voltage"), F.col("customer_type")).alias("voltage_deviation_pct"),
    )


def _staged(name: str, value: Column, to_time) -> Column:
    if name == "timestamp":
        return to_time(value).alias("reading_ts")
    return value.alias("grid_frequency_hz" if name == "frequency_hz" else name)


def _try_time(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def _flag(condition: Column) -> Column:
    """TRUE or FALSE; an unknown condition is FALSE."""
    return F.coalesce(condition, F.lit(False))
