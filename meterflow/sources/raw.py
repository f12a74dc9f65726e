"""Raw JSON events: loading, validation, quarantine, de-duplication."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.functions.times import as_instant
from meterflow.schema import READING_SCHEMA, REQUIRED_KEYS

PARTITIONS = "year int, month int, day int, hour int"


def load_raw(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Raw text lines of an hour-partitioned JSON archive; `where` selects partitions."""
    lines = spark.read.schema(f"value string, {PARTITIONS}").text(path)
    return lines if where is None else lines.filter(where)


def with_load_ts(df: DataFrame, ts: Column | None = None) -> DataFrame:
    """Stamp the load time, in UTC; pass it in to make a load repeatable."""
    now = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    return df.withColumn("load_ts", now if ts is None else ts)


def with_src(df: DataFrame) -> DataFrame:
    """Parse `value` into the variant `src`, NULL where it is not JSON.

    As the output of a generator it is parsed once; a filter on a plain column
    would be moved below it with a copy of the parser for each use.
    """
    return df.select("*", F.explode(F.array(F.try_parse_json("value"))).alias("src"))


def split_bad(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose `value` is JSON, rows whose `value` is not)."""
    parsed = with_src(df)
    return parsed.filter(F.col("src").isNotNull()), df.filter(F.try_parse_json("value").isNull())


def missing_keys(df: DataFrame, required: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """Add `missing`, the required keys that a JSON event does not have, as an array."""
    return with_src(df).withColumn("missing", _missing(required))


def with_reason(df: DataFrame, required: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """Add `reason`, why an event cannot be used; NULL for a usable one."""
    judged = with_judged(df, ["timestamp"], required)
    return judged.select(*df.columns, "src", _missing(required).alias("missing"), "reason")


def with_judged(
    df: DataFrame, names: Sequence[str] = READING_SCHEMA.names, required: Sequence[str] = REQUIRED_KEYS,
) -> DataFrame:
    """Add `src`, the `reason` and `fields`, a struct of the typed fields of `names` and `required`.

    A field that is absent or of another type is NULL. One pass over the event reads all fields; as
    `src`, the struct is the output of a generator, so it is made once and not for each use. An event
    whose required fields are all read is usable. Only of the others the keys are looked up one by one.
    """
    wanted = {*names, *required}
    kept = T.StructType([f for f in READING_SCHEMA.fields if f.name in wanted])
    read = F.try_variant_get("src", "$", kept.simpleString())
    unread = [F.col(f"fields.{k}").isNull() for k in required]
    is_null = [F.is_variant_null(_key(k)) for k in required]
    when = F.col("fields.timestamp").try_cast("timestamp_ntz")
    reason = (
        F.when(~_any(unread) & when.isNotNull(), None)
        .when(F.col("src").isNull(), "bad_json")
        .when(F.size(_missing(required)) > 0, "missing_keys")
        .when(_any(is_null), "null_required")
        .when(_any(unread), "bad_value")
        .otherwise("bad_timestamp")
    )
    return with_src(df).select("*", F.explode(F.array(read)).alias("fields")).withColumn("reason", reason)


def quarantine(df: DataFrame, required: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """The unusable events with their `reason` and raw text."""
    return with_reason(df, required).filter(F.col("reason").isNotNull()).drop("src", "missing")


def usable(df: DataFrame, required: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """The events that `quarantine` does not hold, with `src` parsed."""
    return with_reason(df, required).filter(F.col("reason").isNull()).drop("missing", "reason")


def fill_defaults(df: DataFrame) -> DataFrame:
    """Give absent measures their default: 0.0, 60 Hz, state `normal`."""
    zero = {c: 0.0 for c in ("kwh_delta", "power_kw", "power_factor", "voltage")}
    return df.fillna({**zero, "frequency_hz": 60.0, "meter_state": "normal"})


def dedup(df: DataFrame, watermark: str | None = None) -> DataFrame:
    """One row per event_id, in a batch the copy loaded first.

    A stream needs a `watermark`, how far apart copies may arrive.
    """
    if watermark is None:
        own = F.xxhash64(*[c for c in df.columns if c != "src"])
        first = F.struct("load_ts", own) if "load_ts" in df.columns else own
        return df.groupBy("event_id").agg(F.min_by(F.struct("*"), first).alias("_first")).select("_first.*")
    timed = df.withColumn("_at", as_instant(F.col("reading_ts"))).withWatermark("_at", watermark)
    return timed.dropDuplicatesWithinWatermark(["event_id"]).drop("_at")


def _missing(required: Sequence[str]) -> Column:
    absent = [F.when(_key(k).isNull(), F.lit(k)) for k in required]
    return F.when(F.col("src").isNotNull(), F.array_compact(F.array(*absent)))


def _key(name: str) -> Column:
    return F.variant_get("src", f"$.{name}", "variant")


def _any(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out | condition
    return out
