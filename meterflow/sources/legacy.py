"""The older event shape and its mapping onto the current one."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions.meters import event_type_of
from meterflow.functions.times import iso_text
from meterflow.schema import READING_SCHEMA

LEGACY_SCHEMA = (
    "meter_id string, zone string, meter_type string, timestamp string, kwh double, "
    "voltage double, current_a double, power_factor double, grid_frequency double, "
    "meter_state string, is_anomaly boolean, produced_at string"
)
# Meter types of the older events.
LEGACY_TYPES = {
    "residential": "residential_standard",
    "commercial": "commercial_3phase",
    "industrial": "industrial_heavy",
}


def normalise_legacy(legacy: DataFrame) -> DataFrame:
    """Legacy events as current readings; what they lack is NULL."""
    amps, volts, pf = F.col("current_a"), F.col("voltage"), F.col("power_factor")
    known = legacy.select(
        F.sha2(F.concat_ws("|", "meter_id", "timestamp"), 256).alias("event_id"),
        "meter_id",
        F.col("zone").alias("zone_id"),
        F.substring_index("meter_type", "_", 1).alias("customer_type"),
        F.to_timestamp_ntz("timestamp").alias("reading_ts"),
        F.col("kwh").alias("kwh_delta"),
        "voltage",
        amps.alias("current_amps"),
        "power_factor",
        F.round(volts * amps * pf / 1000 + 1e-9, 3).alias("power_kw"),
        F.col("grid_frequency").alias("frequency_hz"),
        "meter_state",
        "is_anomaly",
        event_type_of(F.col("meter_state")).alias("event_type"),
    )
    absent = {
        f.name: F.lit(None).cast(f.dataType)
        for f in READING_SCHEMA.fields
        if f.name not in known.columns and f.name != "timestamp"
    }
    return known.withColumns(absent)


def union_readings(current: DataFrame, legacy: DataFrame) -> DataFrame:
    """Current readings together with normalised legacy ones."""
    return current.unionByName(normalise_legacy(legacy), allowMissingColumns=True)


def as_legacy(df: DataFrame) -> DataFrame:
    """Readings in the legacy shape, to exercise the mapping."""
    kinds = F.create_map(*[F.lit(x) for pair in LEGACY_TYPES.items() for x in pair])
    return df.select(
        "meter_id",
        F.col("zone_id").alias("zone"),
        kinds[F.col("customer_type")].alias("meter_type"),
        iso_text(F.col("reading_ts")).alias("timestamp"),
        F.col("kwh_delta").alias("kwh"),
        "voltage",
        F.col("current_amps").alias("current_a"),
        "power_factor",
        F.col("frequency_hz").alias("grid_frequency"),
        "meter_state",
        "is_anomaly",
        iso_text(F.col("load_ts")).alias("produced_at"),
    )


def load_legacy(spark, path: str) -> DataFrame:
    """Legacy JSON Lines."""
    return spark.read.schema(LEGACY_SCHEMA).json(path)
