"""Analyses of meter behaviour over the readings."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.meters import interval_seconds
from meterflow.functions.numbers import percent, round_half_up, sum_kwh
from meterflow.functions.times import day_start, hour_start, second_of_day, seconds_between
from meterflow.operators.ordered import with_halo, without_halo
from meterflow.schema import LEGAL_TRANSITIONS, PEAK_HOURS, SCENARIOS

ORDER = ("reading_ts", "event_id")


def dim_meter(stg: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """One row per meter, with the attributes of its latest reading."""
    latest = F.max(F.struct(*order, "zone_id", "customer_type", "firmware_version"))
    return (
        stg.groupBy("meter_id").agg(
            latest.alias("_l"),
            F.min("reading_ts").alias("first_seen"), F.max("reading_ts").alias("last_seen"),
            F.count("*").alias("reading_count"))
        .select("meter_id", "_l.zone_id", "_l.customer_type", "_l.firmware_version",
                "first_seen", "last_seen", "reading_count")
    )


def absent_meters(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Meters of `dim` without any reading on a day between the first and last day of `df`."""
    seen = df.select("meter_id", day_start(F.col("reading_ts")).alias("reading_date")).distinct()
    first = df.agg(F.min(F.col("reading_ts").cast("date"))).scalar()
    last = df.agg(F.max(F.col("reading_ts").cast("date"))).scalar()
    days = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    due = dim.select("zone_id", "meter_id", days.alias("d")).select(
        "zone_id", "meter_id", F.col("d").cast("timestamp_ntz").alias("reading_date"))
    return due.join(seen, ["meter_id", "reading_date"], "left_anti").select(
        "zone_id", "meter_id", "reading_date")


def absent_per_zone(absent: DataFrame) -> DataFrame:
    return absent.groupBy("zone_id", "reading_date").agg(F.count("*").alias("absent_meters"))


def expected_throughput(dim: DataFrame) -> DataFrame:
    """Readings a fleet should send per minute, hour and day, from its intervals."""
    per_second = F.sum(1.0 / interval_seconds(F.col("customer_type")))
    return dim.agg(
        F.count("*").alias("meters"),
        round_half_up(per_second * 60, 4).alias("per_minute"),
        round_half_up(per_second * 3600, 4).alias("per_hour"),
        round_half_up(per_second * 86400, 4).alias("per_day"))


def reading_completeness(df: DataFrame) -> DataFrame:
    """Readings per meter and day against what its interval should give."""
    due = (F.lit(86400) / interval_seconds(F.col("customer_type"))).cast("bigint")
    return (
        df.groupBy("meter_id", "customer_type", day_start(F.col("reading_ts")).alias("reading_date"))
        .agg(F.count("*").alias("observed"))
        .withColumn("expected", due)
        .withColumn("complete_pct", percent(F.col("observed"), F.col("expected"), 3))
    )


def silence_gaps(df: DataFrame, k: int = 3, order: Sequence[str] = ORDER) -> DataFrame:
    """Pauses of a meter longer than `k` of its reading intervals."""
    rows, w = with_halo(
        df, ["meter_id"], order, hour_start(F.col("reading_ts")),
        ["event_id", "zone_id", "customer_type"], 1)
    gaps = without_halo(rows.withColumn("silent_from", F.lag("reading_ts").over(w)))
    lasted = seconds_between(F.col("silent_from"), F.col("reading_ts"))
    return (
        gaps.withColumn("gap_seconds", lasted)
        .filter(F.col("gap_seconds") > k * interval_seconds(F.col("customer_type")))
        .select("meter_id", "zone_id", "silent_from", F.col("reading_ts").alias("silent_to"),
                "gap_seconds")
    )


def odometer_breaks(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Readings whose odometer is below the meter's reading before."""
    rows, w = with_halo(
        df, ["meter_id"], order, hour_start(F.col("reading_ts")), ["event_id", "kwh_reading"], 1)
    with_previous = rows.withColumn("previous_kwh", F.lag("kwh_reading").over(w))
    return (
        without_halo(with_previous).filter(F.col("kwh_reading") < F.col("previous_kwh"))
        .select("event_id", "meter_id", "reading_ts", "previous_kwh", "kwh_reading")
    )


def state_transitions(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """How often a meter goes from one state to another, and whether it may."""
    rows, w = with_halo(
        df, ["meter_id"], order, hour_start(F.col("reading_ts")), ["meter_state"], 1)
    moves = without_halo(rows.withColumn("from_state", F.lag("meter_state").over(w)))
    legal = F.col("from_state") == F.col("to_state")
    for source, target in LEGAL_TRANSITIONS:
        legal = legal | ((F.col("from_state") == source) & (F.col("to_state") == target))
    return (
        moves.filter(F.col("from_state").isNotNull())
        .groupBy("from_state", F.col("meter_state").alias("to_state"))
        .agg(F.count("*").alias("transitions"))
        .withColumn("is_legal", legal)
    )


def fault_episodes(df: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Stretches of consecutive readings of a meter outside the normal state.

    Readings are put in order within an hour of a meter. Only the first and the
    last stretch of an hour can go on in another one; those alone are put in
    order over the whole meter.
    """
    in_hour = Window.partitionBy("meter_id", "_hour").orderBy(*order)
    changed = F.coalesce(F.col("meter_state") != F.lag("meter_state").over(in_hour), F.lit(True))
    numbered = (
        df.select("meter_id", *order, "meter_state", hour_start(F.col("reading_ts")).alias("_hour"))
        .withColumn("_changed", changed.cast("int"))
        .withColumn("_run", F.sum("_changed").over(in_hour.rowsBetween(Window.unboundedPreceding, 0)))
    )
    measures = [F.min("started").alias("started"), F.max("ended").alias("ended"),
                F.sum("reading_count").alias("reading_count")]
    runs = (
        numbered.groupBy("meter_id", "_hour", "_run", "meter_state")
        .agg(F.min("reading_ts").alias("started"), F.max("reading_ts").alias("ended"),
             F.count("*").alias("reading_count"))
        .withColumn("_runs", F.max("_run").over(Window.partitionBy("meter_id", "_hour")))
    )
    at_edge = (F.col("_run") == 1) | (F.col("_run") == F.col("_runs"))
    by_meter = Window.partitionBy("meter_id").orderBy("_hour", "_run")
    goes_on = (F.col("meter_state") == F.lag("meter_state").over(by_meter)) & (
        F.col("_hour") > F.lag("_hour").over(by_meter))
    edges = (
        runs.filter(at_edge)
        .withColumn("_starts", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
        .withColumn("_episode", F.sum("_starts").over(by_meter.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("meter_id", "_episode", "meter_state").agg(*measures).drop("_episode")
    )
    whole = runs.filter(~at_edge).select(*edges.columns)
    return whole.unionByName(edges).filter(F.col("meter_state") != "normal").withColumn(
        "seconds", seconds_between(F.col("started"), F.col("ended")))


def active_scenarios(calendar: Sequence[Mapping] = SCENARIOS) -> Column:
    """Names of the scenarios a reading falls into, as an array.

    A scenario starts daily at its hour and lasts its minutes, over midnight if
    need be. The calendar is a short fixed list, so it becomes part of the
    expression and no join is needed.
    """
    second = second_of_day(F.col("reading_ts"))
    names = []
    for s in calendar:
        inside = F.pmod(second - s["hour"] * 3600, F.lit(86400)) < s["minutes"] * 60
        if s["zones"] != ["ALL"]:
            inside = inside & F.col("zone_id").isin(*s["zones"])
        names.append(F.when(inside, s["name"]))
    return F.array_compact(F.array(*names))


def tag_scenarios(df: DataFrame, calendar: Sequence[Mapping] = SCENARIOS) -> DataFrame:
    """One row per reading and scenario it falls into."""
    return df.withColumn("scenario", F.explode(active_scenarios(calendar)))


def with_calendar(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add `scenarios`, the names of the calendar's entries that hold a reading, in order and each once.

    An entry (scenario, zone_id, start_ts, end_ts) holds the readings of its zone, or of any if that is
    NULL or `ALL`, from its start up to but not including its end. Entries may overlap and run over
    midnight; one without a start, or that ends before it starts, holds none. The joins are on equal
    hours, and zones, with the lists of `calendar_stretches`, and give each reading one row; a list
    has a name as often as its entries leave gaps in the hour, however many of them run in it.
    """
    listed = calendar_stretches(calendar).groupBy("_zone", "_hour").agg(
        F.collect_list(F.struct("scenario", "begins", "ends")).alias("_stretches"))
    anywhere = listed.filter("_zone IS NULL").select("_hour", F.col("_stretches").alias("_all"))
    here = listed.filter("_zone IS NOT NULL").withColumnRenamed("_stretches", "_own")
    at = F.col("reading_ts")

    def names(stretches: str) -> Column:
        held = F.filter(stretches, lambda s: (s["begins"] <= at) & (at < s["ends"]))
        return F.coalesce(F.transform(held, lambda s: s["scenario"]), F.array().cast("array<string>"))

    found = F.sort_array(F.array_distinct(F.concat(names("_all"), names("_own"))))
    return (
        df.withColumns({"_hour": hour_start(at), "_zone": F.col("zone_id")})
        .join(anywhere, "_hour", "left").join(here, ["_zone", "_hour"], "left")
        .select(*[F.col(c) for c in df.columns], found.alias("scenarios"))
    )


def calendar_stretches(calendar: DataFrame) -> DataFrame:
    """The time that the entries of a name and zone cover together, in stretches that do not touch.

    Stretches (scenario, _zone, _hour, begins, ends) are cut at full hours; `_zone` is NULL where
    they hold the readings of any zone. Entries that run into an hour begin with it and become one
    row before any shuffle, so a group sorts no more rows than the hour has times of beginning.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    start, end = (F.col(c).cast("timestamp_ntz") for c in ("start_ts", "end_ts"))
    cut = calendar.filter("end_ts > start_ts AND scenario IS NOT NULL").select(
        "scenario", F.nullif("zone_id", F.lit("ALL")).alias("_zone"), start.alias("_start"), end.alias("_end"),
        F.explode(F.sequence(hour_start(start), hour_start(end - F.expr("INTERVAL 1 MICROSECOND")), hour)).alias("_hour"))
    key = ["scenario", "_zone", "_hour"]
    pieces = cut.groupBy(*key, F.greatest("_start", "_hour").alias("begins")).agg(
        F.max(F.least(F.col("_end"), F.col("_hour") + hour)).alias("ends"))
    by_begin = Window.partitionBy(*key).orderBy("begins")
    reached = F.max("ends").over(by_begin.rowsBetween(Window.unboundedPreceding, -1))
    parted = F.coalesce(F.col("begins") > reached, F.lit(True)).cast("int")
    numbered = pieces.withColumn("_parted", parted).withColumn(
        "_stretch", F.sum("_parted").over(by_begin.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "_stretch").agg(
        F.min("begins").alias("begins"), F.max("ends").alias("ends")).drop("_stretch")


def scenario_impact(df: DataFrame, calendar: Sequence[Mapping] = SCENARIOS) -> DataFrame:
    """Mean energy inside and outside each scenario, per scenario and affected zone."""
    cases = []
    for s in calendar:
        hit = F.lit(True) if s["zones"] == ["ALL"] else F.col("zone_id").isin(*s["zones"])
        inside = F.array_contains("_active", s["name"])
        cases.append(F.when(hit, F.struct(F.lit(s["name"]).alias("scenario"),
                                          inside.alias("inside"))))
    cased = (
        df.withColumn("_active", active_scenarios(calendar))
        .select("zone_id", "kwh_delta", F.inline(F.array_compact(F.array(*cases))))
    )
    inside, outside = F.when(F.col("inside"), F.col("kwh_delta")), F.when(
        ~F.col("inside"), F.col("kwh_delta"))
    return cased.groupBy("scenario", "zone_id").agg(
        F.count_if("inside").alias("readings_inside"),
        round_half_up(F.avg(inside), 4).alias("avg_kwh_inside"),
        round_half_up(F.avg(outside), 4).alias("avg_kwh_outside"))


def peak_offpeak(stg: DataFrame, hours: Mapping[str, Sequence[int]] = PEAK_HOURS) -> DataFrame:
    """Energy in and outside the peak hours of each customer type."""
    peak = F.lit(False)
    for kind, at in hours.items():
        if at:
            peak = peak | ((F.col("customer_type") == kind) & F.col("hour_of_day").isin(*at))
    kwh = F.col("kwh_delta")
    return stg.withColumn("_peak", peak).groupBy("customer_type").agg(
        sum_kwh(F.when(F.col("_peak"), kwh).otherwise(0.0)).alias("peak_kwh"),
        sum_kwh(F.when(~F.col("_peak"), kwh).otherwise(0.0)).alias("offpeak_kwh"),
        F.count_if("_peak").alias("peak_readings"),
        F.count_if(~F.col("_peak")).alias("offpeak_readings"))


def load_latency(stg: DataFrame) -> DataFrame:
    """Seconds from reading to load, mean and maximum per hour of reading."""
    seconds = seconds_between(F.col("reading_ts"), F.col("load_ts"))
    return stg.groupBy("reading_hour").agg(
        round_half_up(F.avg(seconds), 3).alias("avg_latency_seconds"),
        F.max(seconds).alias("max_latency_seconds"),
        F.count("*").alias("reading_count"))
