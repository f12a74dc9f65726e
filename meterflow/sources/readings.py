"""Meter readings made of the `events` table, and variants of them for checks."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.meters import by_value, event_type_of, interval_seconds
from meterflow.functions.numbers import kwh_units
from meterflow.functions.times import floor_window, hour_start, iso_text, seconds_interval, whole_second
from meterflow.operators.ordered import running_by_slot
from meterflow.schema import NOMINAL_VOLTS, READING_SCHEMA, WINDOW_SECONDS, ZONES

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, "
    "event_type string, value double, props string"
)
# Arrival order of the readings; event ids are handed out in that order.
ORDER = ("reading_ts", "arrival_seq")


def readings(
    spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None,
) -> DataFrame:
    """One row per event, typed as a meter reading (without the odometer).

    The bounds, whole seconds from `since` up to but not including `until`, reach the scan.
    """
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        events = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    return from_events(events)


def newest_window(spark: SparkSession, sf_dir: str, seconds: int = WINDOW_SECONDS) -> datetime | None:
    """The start of the window of the newest reading; reads the time column alone."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return events.agg(floor_window(F.max("ts"), seconds)).first()[0]


def from_events(events: DataFrame) -> DataFrame:
    """Turn event rows, batch or streaming, into readings."""
    user, k = F.col("user_id"), F.col("k")
    type_slot = (user * 7) % 50
    base = events.select(
        _props_k().alias("k"),
        F.col("event_id").alias("arrival_seq"),
        F.col("event_id").cast("string").alias("event_id"),
        F.concat(F.lit("MTR-"), _four_digits(user)).alias("meter_id"),
        by_value(user % 5, dict(enumerate(ZONES))).alias("zone_id"),
        F.when(type_slot < 35, "residential").when(type_slot < 47, "commercial")
        .otherwise("industrial").alias("customer_type"),
        whole_second(F.col("ts")).alias("reading_ts"),
        F.rint(F.col("value") * 100).cast("bigint").alias("units"),
        F.when(F.col("event_type") == "signup", "degraded")
        .when(F.col("event_type") == "error", "fault")
        .when((F.col("event_type") == "purchase") & (k % 10 == 0), "silent")
        .otherwise("normal").alias("meter_state"),
    )
    per_hour = (F.lit(3600) / interval_seconds(F.col("customer_type"))).cast("int")
    nominal = by_value(F.col("customer_type"), NOMINAL_VOLTS)
    # units * readings per hour * power factor percent = power in 0.000001 kW
    micro_kw = F.col("units") * per_hour * (80 + k % 20)
    typed = base.select(
        "k", "arrival_seq", "event_id", "meter_id", "zone_id", "customer_type", "reading_ts",
        (F.col("units") / 10000.0).alias("kwh_delta"),
        (nominal * (80 + k % 41) / 100.0).alias("voltage"),
        ((80 + k % 20) / 100.0).alias("power_factor"),
        (F.floor((micro_kw + 500) / 1000) / 1000.0).alias("power_kw"),
        (60 + (k % 13 - 6) / 10.0).cast("double").alias("frequency_hz"),
        "meter_state",
        (k >= 97).alias("is_anomaly"),
        (-50 - k % 41).alias("signal_strength_dbm"),
        F.lit("v3.2.1").alias("firmware_version"),
        event_type_of(F.col("meter_state")).alias("event_type"),
        (F.col("reading_ts") + seconds_interval(k * 10)).alias("load_ts"),
    )
    amps = F.col("kwh_delta") * per_hour * 1000 / F.col("voltage")
    return typed.withColumn("current_amps", F.round(amps + 1e-9, 3))


def _props_k() -> Column:
    """`k` of the JSON in `props`; `{"k": 1}` is read directly, any other shape is parsed."""
    props = F.col("props")
    inner = F.substring(props, 7, F.length(props) - 7).try_cast("int")
    direct = F.when(props.startswith('{"k": ') & props.endswith("}"), inner)
    return F.coalesce(direct, F.get_json_object(props, "$.k").cast("int"))


def _four_digits(number: Column) -> Column:
    """Zero-padded to four digits; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(number < 10000, F.lpad(text, 4, "0")).otherwise(text)


def with_odometer(df: DataFrame) -> DataFrame:
    """Add the cumulative meter value `kwh_reading`, starting at 1000."""
    units = running_by_slot(
        df.withColumn("_units", kwh_units(F.col("kwh_delta"))),
        ["meter_id"], ORDER, hour_start(F.col("reading_ts")), "_units", "_total",
    )
    total = (F.lit(10_000_000) + F.col("_total")) / 10000.0
    return units.withColumn("kwh_reading", total).drop("_units", "_total")


def as_json(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    """`value` = the reading as one JSON text with its 17 keys, plus `extra` columns."""
    return df.select(F.to_json(json_struct()).alias("value"), *extra)


def json_struct(**replace: Column | None) -> Column:
    """The 17 event keys as a struct; `replace` swaps a key's value, None drops the key."""
    fields = []
    for name in READING_SCHEMA.names:
        if name in replace:
            if replace[name] is not None:
                fields.append(replace[name].alias(name))
        elif name == "timestamp":
            fields.append(iso_text(F.col("reading_ts")).alias(name))
        else:
            fields.append(F.col(name))
    return F.struct(*fields)


def bad_json(df: DataFrame) -> DataFrame:
    """Readings as JSON with broken rows: k = 0 cut text, 1 no power, 2 null energy, 3 bad time.

    The texts go without the odometer, which no check asks for.
    """
    def event(**replace):
        return json_struct(kwh_reading=None, **replace)

    whole = F.to_json(event())
    null_energy = event(kwh_delta=F.lit(None).cast("double"))
    value = (
        F.when(F.col("k") == 0, F.left(whole, F.lit(20)))
        .when(F.col("k") == 1, F.to_json(event(power_kw=None)))
        .when(F.col("k") == 2, F.to_json(null_energy, {"ignoreNullFields": "false"}))
        .when(F.col("k") == 3, F.to_json(event(timestamp=F.lit("not-a-time"))))
        .otherwise(whole)
    )
    return df.select("arrival_seq", "k", "load_ts", value.alias("value"))


def duplicated(df: DataFrame) -> DataFrame:
    """Readings with the rows of k % 25 = 0 delivered twice."""
    copies = F.when(F.col("k") % 25 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def out_of_order(df: DataFrame) -> DataFrame:
    """Readings with `arrival`: rows of k % 10 = 0 come five places late."""
    late = F.when(F.col("k") % 10 == 0, 5).otherwise(0)
    return df.withColumn("arrival", F.col("arrival_seq") + late)


def with_faults(df: DataFrame) -> DataFrame:
    """Readings with negative energy where k = 4 and an unknown zone where k = 5."""
    return df.withColumns({
        "kwh_delta": F.when(F.col("k") == 4, -F.col("kwh_delta")).otherwise(F.col("kwh_delta")),
        "zone_id": F.when(F.col("k") == 5, "ZONE-X").otherwise(F.col("zone_id")),
    })


def with_odometer_reset(df: DataFrame) -> DataFrame:
    """Odometer readings whose value drops by 500 from a meter's first k = 7 row on."""
    marked = running_by_slot(
        with_odometer(df).withColumn("_seen", (F.col("k") == 7).cast("int")),
        ["meter_id"], ORDER, hour_start(F.col("reading_ts")), "_seen", "_reset", how="max",
    )
    value = F.col("kwh_reading") - F.col("_reset") * 500
    return marked.withColumn("kwh_reading", value).drop("_seen", "_reset")
