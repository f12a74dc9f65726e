"""The hourly batch: raw hours -> staging -> checks -> marts."""

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.operators.marts import (
    PARTIAL_KEYS, mart_customer_segment, mart_demand_heatmap, mart_fault_summary, mart_zone_daily, marts_of_partials,
    meter_partials, zone_daily_of_partials, zone_partials,
)
from meterflow.operators.quality import dq_report, failed_checks, staging_checks
from meterflow.operators.staging import staging
from meterflow.sources.archive import HOUR_COLS, hours_between, ready_hours
from meterflow.sources.raw import load_raw, with_load_ts, with_reason
from meterflow.storage import materialise

MARTS = {
    "mart_demand_heatmap": mart_demand_heatmap,
    "mart_zone_daily": mart_zone_daily,
    "mart_fault_summary": mart_fault_summary,
    "mart_customer_segment": mart_customer_segment,
}


class ChecksFailed(Exception):
    """Raised instead of building marts; `report` holds the failing checks."""

    def __init__(self, report: list):
        super().__init__("; ".join(
            f"{r.check_name}({r.column_name}): {r.failed_rows} rows" for r in report))
        self.report = report


def run_hourly_load(
    spark: SparkSession, raw_path: str, out: str, hours: tuple[datetime, datetime],
    load_ts: Column | None = None, pattern: str = "*", staging_schema: str = "staging", mart_schema: str = "mart",
) -> dict[str, DataFrame] | None:
    """Stage the raw hours [start, end) and renew the four marts if the checks pass.

    The cost follows the hours loaded: these are summed up, one row for each group and
    event hour, below `out/<mart_schema>-partials`, and marts and checks are added up from
    such rows of all hours (`renew_marts`). The staged history is not read.

    Returns None while no file of these hours, with a name that fits `pattern`,
    has arrived. The raw text is parsed once. Under `out/<staging_schema>` every
    event hour has a folder, and a load replaces exactly the hours it loads: it
    can run again, overlap another or fill a gap, and nothing counts twice. Of
    copies of an event the first loaded stays. An event that cannot be used is
    kept there too, as text and with the `reason`, and stops no load.
    """
    where = hours_between(*hours)
    if ready_hours(spark, raw_path, pattern).filter(where).isEmpty():
        return None
    lines = with_reason(with_load_ts(load_raw(spark, raw_path, where), load_ts))
    bad = F.col("reason").isNotNull()
    typed = staging(lines, strict=False, keep=["value", "reason", *HOUR_COLS])
    # usable events are grouped by id; other rows all stay, spread by their text
    single = bad | F.col("event_id").isNull()
    place = F.when(single, F.xxhash64("value").cast("string")).otherwise(F.col("event_id"))
    copies = Window.partitionBy("_place", "_single").orderBy("load_ts", F.xxhash64("value"))
    once = (
        typed.withColumns({"_single": single, "_place": place})
        .withColumn("_copy", F.row_number().over(copies))
        .filter("_copy = 1 OR _single").drop("_place", "_single", "_copy")
        .withColumn("value", F.when(bad, F.col("value")))
    )
    staged = f"{out}/{staging_schema}"
    (
        once.hint("rebalance", *HOUR_COLS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*HOUR_COLS).parquet(staged)
    )
    stg = read_staging(spark, staged)
    stg.createOrReplaceTempView("stg_meter_readings")
    write_partials(spark, staged, f"{out}/{mart_schema}-partials", where)
    return renew_marts(spark, f"{out}/{mart_schema}-partials", f"{out}/{mart_schema}")


#: The partials of a day's hours are one folder.
DAY_COLS = HOUR_COLS[:3]


def write_partials(spark: SparkSession, staged: str, path: str, where: Column) -> None:
    """Sum up the staged hours that `where` selects, in place of what was there of these hours.

    Every row says when it was made. A day that an hour no longer has readings of keeps a row of 0
    readings, from which `renew_marts` sees that the day has changed.
    """
    rows = spark.read.parquet(staged).filter(where)
    usable = F.col("reason").isNull()
    failed = {f"failed_{i}": c.failed for i, c in enumerate(staging_checks())}
    sums = {"zones": zone_partials(rows, HOUR_COLS, usable, failed), "meters": meter_partials(rows, HOUR_COLS, usable)}
    sums = {name: materialise(new.withColumn("made", F.lit(_now())), name) for name, new in sums.items()}
    hours = sums["zones"].select(*HOUR_COLS).distinct()
    days = hours.select(*DAY_COLS).distinct().collect()  # of the load
    if _exists(spark, f"{path}/zones"):
        for name, new in sums.items():
            there = _of_days(spark.read.parquet(f"{path}/{name}"), days)
            kept = there.join(hours, HOUR_COLS, "left_anti")
            if name == "zones":
                gone = there.join(hours, HOUR_COLS, "left_semi").select(*HOUR_COLS, "reading_date").distinct()
                zero = [F.lit(0).cast("long").alias(f.name) for f in new.schema.fields
                        if f.dataType.typeName() == "long" and f.name != "units"]
                blank = gone.select(*HOUR_COLS, "reading_date", *zero, F.lit(_now()).alias("made"))
                kept = kept.unionByName(blank, allowMissingColumns=True)
            sums[name] = materialise(new.unionByName(kept, allowMissingColumns=True), name)
    for name, new in sums.items():
        (
            new.hint("rebalance", *DAY_COLS).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*DAY_COLS).parquet(f"{path}/{name}")
        )


def renew_marts(spark: SparkSession, partials: str, out: str) -> dict[str, DataFrame]:
    """Write a new version of all marts from the partials, or raise `ChecksFailed` as `build_marts`.

    Of the daily mart only the days with partials younger than the last version are built
    anew, from the folders that have readings of them; the others are carried over.
    """
    zones = spark.read.parquet(f"{partials}/zones")
    checks = staging_checks()
    counts = zones.agg(*[F.sum(f"failed_{i}").alias(f"_{i}") for i in range(len(checks))])
    report = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.column).alias("column_name"), F.col(f"_{i}").alias("failed_rows"))
              for i, c in enumerate(checks)]
    failed = failed_checks(counts.select(F.inline(F.array(*report)))).collect()  # one row per check
    if failed:
        raise ChecksFailed(failed)
    last = _last_version(spark, out)
    meters, carried = spark.read.parquet(f"{partials}/meters"), None
    if last is not None:
        days = materialise(zones.filter(F.col("made") > last).select("reading_date").distinct(), "days")
        folders = zones.join(days, "reading_date", "left_semi").select(*DAY_COLS).distinct().collect()  # of the days loaded
        carried = read_marts(spark, out)["mart_zone_daily"].join(days, "reading_date", "left_anti")
        meters = _of_days(meters, folders).join(days, "reading_date", "left_semi")
    daily = zone_daily_of_partials(meters)
    if carried is not None:
        daily = daily.unionByName(carried).orderBy("zone_id", "reading_date")
    return _write_version(spark, {**marts_of_partials(zones), "mart_zone_daily": daily}, out)


def _of_days(rows: DataFrame, days: list) -> DataFrame:
    """The rows of some day folders, by a condition on the folders that prunes the others."""
    wanted = F.lit(False)
    for d in days:
        wanted = wanted | ((F.col("year") == d.year) & (F.col("month") == d.month) & (F.col("day") == d.day))
    return rows.filter(wanted)


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """The usable events of all loads, as staging rows."""
    return spark.read.parquet(path).filter(F.col("reason").isNull()).drop("value", "reason", *HOUR_COLS)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The events of all loads that cannot be used: text, reason, load time and hour folder."""
    return spark.read.parquet(path).filter(F.col("reason").isNotNull()).select(
        "value", "reason", "load_ts", *HOUR_COLS)


def build_marts(stg: DataFrame, out: str) -> dict[str, DataFrame]:
    """Write a new version of all marts under `out`, or raise `ChecksFailed` and leave them as they are.

    Readers see a version (`read_marts`) when its entry in `out/versions` is
    there, which is written last: never some marts of one load and some of another.
    """
    failed = failed_checks(dq_report(stg)).collect()  # one row per check
    if failed:
        raise ChecksFailed(failed)
    return _write_version(stg.sparkSession, {name: mart(stg) for name, mart in MARTS.items()}, out)


def _write_version(spark: SparkSession, marts: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    version = _now()
    for name, mart in marts.items():
        mart.write.mode("overwrite").parquet(f"{out}/{version}/{name}")
    entry = spark.createDataFrame([(version,)], "version string")
    entry.coalesce(1).write.mode("append").parquet(f"{out}/versions")
    return read_marts(spark, out)


def _now() -> str:
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}"


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def _last_version(spark: SparkSession, out: str) -> str | None:
    return spark.read.parquet(f"{out}/versions").agg(F.max("version")).first()[0] if _exists(spark, f"{out}/versions") else None


def read_marts(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The marts of the latest whole version."""
    version = spark.read.parquet(f"{out}/versions").agg(F.max("version")).first()[0]
    return {name: spark.read.parquet(f"{out}/{version}/{name}") for name in MARTS}
