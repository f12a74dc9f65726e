"""Data-quality checks over the staging view."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.numbers import percent
from meterflow.operators.windows import slot_grid
from meterflow.schema import STATES, ZONES


@dataclass(frozen=True)
class Check:
    """A check and the condition of a row that fails it."""

    name: str
    column: str
    failed: Column


def not_null(column: str) -> Check:
    return Check("not_null", column, F.col(column).isNull())


def accepted_values(column: str, values: Sequence[str]) -> Check:
    """NULL passes; it is the business of `not_null`."""
    return Check("accepted_values", column, ~F.col(column).isin(*values))


def not_negative(column: str) -> Check:
    return Check("not_negative", column, F.col(column) < 0)


def staging_checks() -> list[Check]:
    return [
        not_null("meter_id"),
        not_null("zone_id"),
        not_null("kwh_delta"),
        accepted_values("zone_id", ZONES),
        accepted_values("meter_state", STATES),
        not_negative("kwh_delta"),
    ]


def dq_report(stg: DataFrame, checks: Sequence[Check] | None = None) -> DataFrame:
    """One row per check with its number of failing rows, all counted in one scan."""
    checks = staging_checks() if checks is None else checks
    counts = stg.agg(*[F.count_if(c.failed).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"),
                 F.col(f"_{i}").alias("failed_rows"))
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def gate(report: DataFrame) -> DataFrame:
    """One row: how many checks failed, and whether the marts may be built."""
    failed = F.count_if(F.col("failed_rows") > 0)
    return report.agg(
        F.count("*").alias("checks"), failed.alias("failed_checks"),
        F.sum("failed_rows").alias("failed_rows"), (failed == 0).alias("marts_built"))


def failed_checks(report: DataFrame) -> DataFrame:
    return report.filter(F.col("failed_rows") > 0)


def negative_kwh(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("kwh_delta") < 0)


def dq_duplicates(stg: DataFrame) -> DataFrame:
    """Event ids that occur more than once."""
    return stg.groupBy("event_id").agg(F.count("*").alias("copies")).filter("copies > 1")


def hour_completeness(stg: DataFrame, expected: DataFrame | Mapping[str, int]) -> DataFrame:
    """Meters that reported against the expected number, for every zone and hour from the first to the last.

    The zones are those of `expected` and of the readings; an hour without any reading has 0 meters.
    """
    seen = stg.groupBy("zone_id", "reading_hour").agg(F.count_distinct("meter_id").alias("meters"))
    if not isinstance(expected, DataFrame):
        expected = stg.sparkSession.createDataFrame(list(expected.items()), "zone_id string, n long")
    named = expected.select("zone_id", F.lit(None).cast("timestamp_ntz").alias("reading_hour"))
    bounds = seen.select("zone_id", "reading_hour").unionByName(named).agg(
        F.min("reading_hour").alias("lo"), F.max("reading_hour").alias("hi"), F.collect_set("zone_id").alias("zones"))
    grid = slot_grid(bounds, 3600).withColumnRenamed("slot", "reading_hour")
    return (
        grid.join(seen, ["zone_id", "reading_hour"], "left").join(expected, "zone_id", "left")
        .withColumn("meters", F.coalesce("meters", F.lit(0)))
        .select("zone_id", "reading_hour", "meters", F.col("n").alias("expected"),
                percent(F.col("meters"), F.col("n")).alias("complete_pct"))
    )


def voltage_out_of_band(stg: DataFrame, pct: float = 0.10) -> DataFrame:
    return stg.filter(F.col("voltage_deviation_pct") > pct)


def frequency_out_of_band(stg: DataFrame, nominal: float = 60.0, tol: float = 0.5) -> DataFrame:
    """Readings off the nominal frequency by more than `tol`; an exact `tol` is in band."""
    return stg.filter(F.abs(F.col("grid_frequency_hz") - nominal) > tol + 1e-9)


def power_residuals(df: DataFrame, tol: float = 0.0005) -> DataFrame:
    """Readings whose power is not voltage * current * power factor within `tol` kW."""
    product = F.col("voltage") * F.col("current_amps") * F.col("power_factor") / 1000.0
    residual = F.round(F.abs(F.col("power_kw") - product) + 1e-9, 6)
    return df.withColumn("residual_kw", residual).filter(F.col("residual_kw") > tol)


# Default lower edge in dBm of each signal band; only the ends, -50 and -90, are given.
SIGNAL_EDGES = {"excellent": -60, "good": -70, "fair": -80, "poor": -89}


def signal_bands(stg: DataFrame, edges: Mapping[str, int] = SIGNAL_EDGES) -> DataFrame:
    """Readings per zone and band of signal strength; below every edge is very poor, NULL is unknown."""
    band = F.when(F.col("signal_strength_dbm").isNull(), "unknown")
    for name, edge in edges.items():
        band = band.when(F.col("signal_strength_dbm") >= edge, name)
    return (
        stg.withColumn("signal_band", band.otherwise("very_poor"))
        .groupBy("zone_id", "signal_band").agg(F.count("*").alias("reading_count"))
    )
