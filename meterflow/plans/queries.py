"""The registered queries: each runs over the whole tables of a folder."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions import times
from meterflow.operators import analysis, anomaly, dashboards, marts, quality, routing, windows
from meterflow.operators.staging import staging, staging_from_readings, staging_from_text
from meterflow.plans.hourly_load import build_marts, run_hourly_load
from meterflow.sources import archive, legacy, raw
from meterflow.sources import readings as src
from meterflow.sources.readings import ORDER, readings
from meterflow.storage import materialise, scratch_path
from meterflow.streaming import anomaly as stream_anomaly
from meterflow.streaming.live import run_live
from meterflow.streaming.silence import start_silence_alarms
from meterflow.streaming.sinks import read_latest, start_log
from meterflow.streaming.sources import parse_messages, read_stream, replay_readings
from meterflow.streaming.windows import closed_windows as stream_closed_windows
from meterflow.streaming.windows import read_window_deltas, read_windows, start_window_log

QUERIES = {}


def query(fn):
    """Register a query under the name of its function."""
    QUERIES[fn.__name__] = fn
    return fn


def _stg(spark: SparkSession, sf: str) -> DataFrame:
    return staging_from_readings(readings(spark, sf))


def _json(spark: SparkSession, sf: str, extra: list[str]) -> DataFrame:
    return src.as_json(src.with_odometer(readings(spark, sf)), extra)


def _archive(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "archive")
    archive.write_archive(_json(spark, sf, ["reading_ts"]), path, fmt="text")
    return path


def _windows(spark: SparkSession, sf: str, seconds: int = 300) -> DataFrame:
    r = readings(spark, sf)
    return windows.zone_window_agg(r, seconds, windows.expected_meters(r))


def _flagged(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    """Flagged readings with only the columns a query needs: all of them pass through Python."""
    cols = ["arrival_seq", "meter_id", "reading_ts", "kwh_delta", *more]
    return anomaly.ema_anomaly(readings(spark, sf).select(*cols), order=ORDER)


def _full(spark: SparkSession, sf: str) -> DataFrame:
    r = readings(spark, sf)
    agg = windows.zone_window_agg(r, expected=windows.expected_meters(r))
    counts = windows.anomaly_counts(_flagged(spark, sf, "zone_id"))
    joined = agg.join(counts, ["zone_id", "window_start_ts"], "left")
    counted = joined.withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(0)))
    return windows.in_window_order(windows.with_demand_delta(counted))


# --- sources and sinks -------------------------------------------------------

@query
def src_stream_replay(spark, sf):
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "replayed")
    _json(spark, sf, []).write.text(topic)
    stream = parse_messages(read_stream(spark, "files", path=topic))
    start_log(stream, out, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out).select(
        "event_id", "meter_id", "zone_id", "customer_type", "reading_ts", "kwh_delta", "power_kw",
        "meter_state", "event_type")


@query
def src_json_raw(spark, sf):
    lines = raw.with_src(raw.load_raw(spark, _archive(spark, sf)))
    return lines.select(
        F.variant_get("src", "$.event_id", "string").alias("event_id"),
        F.variant_get("src", "$.kwh_delta", "double").alias("kwh_delta"),
        "year", "month", "day", "hour")


@query
def src_partition_prune(spark, sf):
    where = archive.hours_between(datetime(2024, 1, 10, 6), datetime(2024, 1, 12))
    lines = raw.with_src(raw.load_raw(spark, _archive(spark, sf), where))
    return lines.select(
        F.variant_get("src", "$.event_id", "string").alias("event_id"), "day", "hour")


@query
def sink_hour_partitions(spark, sf):
    lines = raw.load_raw(spark, _archive(spark, sf))
    return lines.groupBy(*archive.HOUR_COLS).agg(F.count("*").alias("reading_count"))


@query
def ready_hours(spark, sf):
    return archive.ready_hours(spark, _archive(spark, sf)).filter("files > 0").drop("files")


@query
def legacy_normalise(spark, sf):
    r = readings(spark, sf)
    return legacy.union_readings(r, legacy.as_legacy(r)).select(
        "event_id", "meter_id", "zone_id", "customer_type", "reading_ts", "kwh_delta", "voltage",
        "current_amps", "power_factor", "power_kw", "frequency_hz", "meter_state", "is_anomaly",
        "signal_strength_dbm", "event_type")


@query
def legacy_load(spark, sf):
    """Legacy JSON Lines, mapped and written to the hour folders of the archive."""
    old, out = scratch_path(spark, "legacy"), scratch_path(spark, "legacy-archive")
    legacy.as_legacy(readings(spark, sf)).write.json(old)
    mapped = legacy.normalise_legacy(legacy.load_legacy(spark, old))
    archive.write_archive(mapped, out, fmt="parquet")
    return spark.read.parquet(out).select(
        "event_id", "meter_id", "zone_id", "customer_type", "kwh_delta", "power_kw", "frequency_hz",
        "year", "month", "day", "hour")


@query
def route_alerts(spark, sf):
    return routing.route_alerts(readings(spark, sf)).select("event_id", "topic", "partition")


@query
def route_partition_counts(spark, sf):
    routed = routing.with_partition(src.with_faults(readings(spark, sf)))
    return routed.groupBy("partition").agg(F.count("*").alias("reading_count"))


@query
def push_rows(spark, sf):
    return routing.to_push_rows(_full(spark, sf))


@query
def window_status(spark, sf):
    return _windows(spark, sf).select(
        "zone_id", "window_start_ts", windows.status_label().alias("status"))


# --- staging and row rules ---------------------------------------------------

@query
def stg_readings(spark, sf):
    return staging(raw.with_src(_json(spark, sf, ["load_ts"])))


@query
def stg_readings_text(spark, sf):
    return staging_from_text(_json(spark, sf, ["load_ts"]))


@query
def dq_bad_json(spark, sf):
    _, bad = raw.split_bad(src.bad_json(readings(spark, sf)))
    return bad.select("arrival_seq", "value")


@query
def dq_missing_keys(spark, sf):
    checked = raw.missing_keys(src.bad_json(readings(spark, sf)))
    return checked.filter(F.size("missing") > 0).select(
        "arrival_seq", F.concat_ws(",", "missing").alias("missing"))


@query
def quarantine(spark, sf):
    bad = src.bad_json(readings(spark, sf))
    return raw.quarantine(bad).select("arrival_seq", "reason")


@query
def filled_defaults(spark, sf):
    """Readings that lack measures where k is below 3, with the defaults in their place."""
    names = ["kwh_delta", "power_kw", "power_factor", "voltage", "frequency_hz", "meter_state"]
    gaps = {c: F.when(F.col("k") != i // 2, F.col(c)) for i, c in enumerate(names)}
    return raw.fill_defaults(readings(spark, sf).withColumns(gaps)).select("event_id", *names)


@query
def dedup_events(spark, sf):
    twice = src.duplicated(readings(spark, sf))
    return raw.dedup(twice).select("event_id", "meter_id", "reading_ts", "kwh_delta")


@query
def dq_negative_kwh(spark, sf):
    return quality.negative_kwh(src.with_faults(readings(spark, sf))).select(
        "event_id", "meter_id", "kwh_delta")


@query
def voltage_out_of_band(spark, sf):
    return quality.voltage_out_of_band(_stg(spark, sf)).select(
        "event_id", "meter_id", "customer_type", "voltage", "voltage_deviation_pct")


@query
def frequency_out_of_band(spark, sf):
    return quality.frequency_out_of_band(_stg(spark, sf)).select(
        "event_id", "meter_id", "grid_frequency_hz")


@query
def signal_bands(spark, sf):
    r = readings(spark, sf)
    return quality.signal_bands(legacy.union_readings(r, legacy.as_legacy(r)))


@query
def power_residuals(spark, sf):
    return quality.power_residuals(readings(spark, sf)).select(
        "event_id", "meter_id", "power_kw", "residual_kw")


@query
def scalar_time_parts(spark, sf):
    ts = F.col("reading_ts")
    text = F.when(F.col("k") == 3, "not-a-time").otherwise(times.iso_text(ts))
    return readings(spark, sf).select(
        "event_id",
        times.iso_text(ts).alias("iso_text"),
        times.epoch_millis(ts).alias("epoch_ms"),
        times.event_hour(text).alias("hour_from_text"),
        times.floor_window(ts, 300).alias("window_5m"),
        times.floor_window(ts, 21600).alias("window_6h"),
        F.year(ts).alias("year"), F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"), F.hour(ts).alias("hour"),
        times.seconds_between(ts, F.col("load_ts")).alias("load_seconds"))


# --- quality -----------------------------------------------------------------

@query
def dq_report(spark, sf):
    return quality.dq_report(staging_from_readings(src.with_faults(readings(spark, sf))))


@query
def dq_duplicates(spark, sf):
    return quality.dq_duplicates(src.duplicated(readings(spark, sf)))


@query
def hour_completeness(spark, sf):
    stg = _stg(spark, sf)
    return quality.hour_completeness(stg, windows.expected_meters(stg))


def _mart_totals(built: dict[str, DataFrame]) -> DataFrame:
    """The marts' rows in one frame: a name, the keys as text, and a measure."""
    parts = [
        built["mart_demand_heatmap"].select(
            F.lit("mart_demand_heatmap").alias("mart"),
            F.concat_ws("|", "zone_id", "hour_of_day", "day_of_week_num").alias("keys"),
            F.col("total_kwh").alias("measure"), F.col("reading_count").alias("readings")),
        built["mart_zone_daily"].select(
            F.lit("mart_zone_daily"), F.concat_ws("|", "zone_id", F.date_format("reading_date", "yyyy-MM-dd")),
            "total_kwh", "active_meter_count"),
        built["mart_fault_summary"].select(
            F.lit("mart_fault_summary"), F.concat_ws("|", "zone_id", F.date_format("reading_date", "yyyy-MM-dd")),
            F.lit(0.0), "total_fault_readings"),
        built["mart_customer_segment"].select(
            F.lit("mart_customer_segment"), "customer_type", "total_kwh", F.lit(0).cast("long")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


@query
def gated_marts(spark, sf):
    return _mart_totals(build_marts(_stg(spark, sf), scratch_path(spark, "marts")))


@query
def hourly_load(spark, sf):
    """Raw text to marts, in three loads: two that overlap by a tenth of the time, and the last hour again."""
    path, out = _archive(spark, sf), scratch_path(spark, "load")
    first, last = readings(spark, sf).agg(F.min("reading_ts"), F.max("reading_ts")).first()
    hour = timedelta(hours=1)
    lo, hi = (t.replace(minute=0, second=0, microsecond=0) for t in (first, last + hour))
    stamp = F.lit(hi).cast("timestamp_ntz")
    for begin, end in ((lo, lo + (hi - lo) * 0.6), (lo + (hi - lo) * 0.5, hi), (hi - hour, hi)):
        built = run_hourly_load(spark, path, out, (begin, end), stamp)
    return _mart_totals(built)


@query
def gate_result(spark, sf):
    faulty = staging_from_readings(src.with_faults(readings(spark, sf)))
    return quality.gate(quality.dq_report(faulty))


# --- windows -----------------------------------------------------------------

@query
def zone_window_agg(spark, sf):
    return _windows(spark, sf)


@query
def window_upsert(spark, sf):
    """What is left when the windows of the first readings are written over by those of all."""
    r, log = readings(spark, sf), scratch_path(spark, "upserts")
    expected = windows.expected_meters(r)
    for i, part in enumerate([r.filter(F.col("arrival_seq") % 2 == 0), r]):
        windows.zone_window_agg(part, expected=expected).write.parquet(f"{log}/batch_id={i}")
    schema = spark.read.parquet(f"{log}/batch_id=1").schema
    return read_latest(spark, log, schema, ["zone_id", "window_start_ts"])


@query
def zone_window_agg_6h(spark, sf):
    return _windows(spark, sf, 21600)


@query
def zone_window_full(spark, sf):
    return _full(spark, sf)


@query
def zone_window_delta(spark, sf):
    w = windows.with_demand_delta(windows.zone_window_agg(readings(spark, sf)))
    return w.select("zone_id", "window_start_ts", "total_kwh", "demand_vs_prev_window_pct")


@query
def zone_window_arrival(spark, sf):
    return windows.zone_window_agg(src.out_of_order(readings(spark, sf)), late="arrival")


@query
def window_grid_filled(spark, sf):
    return windows.fill_window_grid(windows.zone_window_agg(readings(spark, sf)))


def _outages(spark: SparkSession, sf: str, seconds: int) -> DataFrame:
    r = readings(spark, sf)
    return windows.zone_outages(
        windows.zone_window_agg(r, seconds), seconds, windows.expected_meters(r)).select(
        "zone_id", "window_start_ts", "active_meter_count", "silent_meter_count", "silent_ratio")


@query
def zone_outages(spark, sf):
    return _outages(spark, sf, 3600)


@query
def zone_outages_5m(spark, sf):
    return _outages(spark, sf, 300)


@query
def window_grid_faulty(spark, sf):
    """A grid over windows that also have a zone no list names."""
    return windows.fill_window_grid(windows.zone_window_agg(src.with_faults(readings(spark, sf))))


@query
def expected_meters(spark, sf):
    total = readings(spark, sf).agg(F.count_distinct("meter_id").alias("t"))
    split = total.select(F.inline(windows.split_meters(F.col("t"))))
    return split


# --- anomalies and ordered operators -----------------------------------------

@query
def ema_anomaly(spark, sf):
    return _flagged(spark, sf, "event_id").select(
        "event_id", "meter_id", "reading_ts", "is_anomaly_ema")


@query
def ema_baselines(spark, sf):
    last = anomaly.ema_baselines(_flagged(spark, sf), ORDER)
    return last.withColumn("ema_baseline", F.round(F.col("ema_baseline") + 1e-9, 6))


@query
def ema_carried(spark, sf):
    """The flags of two loads, the second from the baselines that the first has left."""
    r = readings(spark, sf).select("arrival_seq", "event_id", "meter_id", "reading_ts", "kwh_delta")
    early = F.col("reading_ts") < F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    first = materialise(anomaly.ema_anomaly(r.filter(early), order=ORDER), "first-load")
    kept = materialise(anomaly.ema_baselines(first, ORDER), "baselines")
    second = anomaly.ema_anomaly(r.filter(~early), carry_in=kept, order=ORDER)
    return first.unionByName(second).select("event_id", "meter_id", "reading_ts", "is_anomaly_ema")


@query
def baseline_lookup(spark, sf):
    """The baseline of every meter at every hour of day, 0.0 where it has no reading."""
    known = anomaly.ema_baselines(_flagged(spark, sf), ORDER)
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("ema_hour")
    wanted = readings(spark, sf).select("meter_id").distinct().select("meter_id", hours)
    found = anomaly.baseline_for_hour(known, wanted)
    return found.withColumn("ema_baseline", F.round(F.col("ema_baseline") + 1e-9, 6))


@query
def rolling_anomaly(spark, sf):
    return anomaly.rolling_anomaly(readings(spark, sf), order=ORDER).select(
        "event_id", "meter_id", "history", "is_anomaly_rolling")


@query
def odometer(spark, sf):
    return src.with_odometer(readings(spark, sf)).select("event_id", "meter_id", "kwh_reading")


@query
def odometer_breaks(spark, sf):
    return analysis.odometer_breaks(src.with_odometer_reset(readings(spark, sf)), ORDER)


@query
def state_transitions(spark, sf):
    return analysis.state_transitions(readings(spark, sf), ORDER)


@query
def fault_episodes(spark, sf):
    return analysis.fault_episodes(readings(spark, sf), ORDER)


@query
def silence_gaps(spark, sf):
    return analysis.silence_gaps(readings(spark, sf), order=ORDER)


# --- marts -------------------------------------------------------------------

@query
def mart_demand_heatmap(spark, sf):
    return marts.mart_demand_heatmap(_stg(spark, sf))


@query
def mart_zone_daily(spark, sf):
    return marts.mart_zone_daily(_stg(spark, sf))


@query
def mart_fault_summary(spark, sf):
    return marts.mart_fault_summary(_stg(spark, sf))


@query
def mart_customer_segment(spark, sf):
    return marts.mart_customer_segment(_stg(spark, sf))


@query
def zone_day_over_day(spark, sf):
    return marts.with_day_over_day(marts.mart_zone_daily(_stg(spark, sf))).select(
        "zone_id", "reading_date", "total_kwh", "day_over_day_pct")


@query
def meter_health_daily(spark, sf):
    return marts.meter_health_daily(_stg(spark, sf))


@query
def segment_daily(spark, sf):
    return marts.segment_daily(_stg(spark, sf))


@query
def segment_weekend(spark, sf):
    return marts.segment_weekend(_stg(spark, sf))


# --- dashboards --------------------------------------------------------------

@query
def kpi_overview(spark, sf):
    return dashboards.kpi_overview(marts.mart_zone_daily(_stg(spark, sf)))


@query
def kpi_faults(spark, sf):
    return dashboards.kpi_faults(marts.mart_fault_summary(_stg(spark, sf)))


@query
def peak_hour_by_zone(spark, sf):
    return dashboards.peak_hour_by_zone(marts.mart_demand_heatmap(_stg(spark, sf)))


@query
def overnight_trough(spark, sf):
    return dashboards.overnight_trough(marts.mart_demand_heatmap(_stg(spark, sf)))


@query
def heatmap_matrix(spark, sf):
    return dashboards.heatmap_matrix(marts.mart_demand_heatmap(_stg(spark, sf)))


@query
def trend_14d(spark, sf):
    return dashboards.daily_trend(marts.mart_zone_daily(_stg(spark, sf)))


@query
def zone_30d_totals(spark, sf):
    return dashboards.zone_totals(marts.mart_zone_daily(_stg(spark, sf)))


@query
def most_faulty_zone(spark, sf):
    return dashboards.most_faulty_zone(marts.mart_fault_summary(_stg(spark, sf)))


@query
def faults_by_zone(spark, sf):
    return dashboards.faults_by_zone(marts.mart_fault_summary(_stg(spark, sf)))


@query
def latest_window_ranked(spark, sf):
    recent = readings(spark, sf, since=src.newest_window(spark, sf))
    return dashboards.latest_window_ranked(windows.zone_window_agg(recent))


@query
def last_six_windows(spark, sf):
    starts = readings(spark, sf).select(
        "zone_id", times.floor_window(F.col("reading_ts"), 300).alias("window_start_ts")).distinct()
    # where the oldest of the wanted windows begins; the measures are read from there on only
    since = dashboards.last_windows(starts).agg(F.min("window_start_ts")).first()[0]
    recent = windows.zone_window_agg(readings(spark, sf, since=since))
    return dashboards.last_windows(recent).select("zone_id", "window_start_ts", "total_kwh")


@query
def live_kpis(spark, sf):
    """The cards of the newest window: its readings, and the baselines that earlier loads left of its hour."""
    since = src.newest_window(spark, sf)
    cols = ["arrival_seq", "meter_id", "zone_id", "reading_ts", "kwh_delta"]
    same_hour = F.hour("reading_ts") == F.hour(F.lit(since).cast("timestamp_ntz"))
    earlier = readings(spark, sf, until=since).select(*cols).filter(same_hour)
    kept = materialise(anomaly.ema_baselines(anomaly.ema_anomaly(earlier, order=ORDER), ORDER), "baselines")
    recent = readings(spark, sf, since=since)
    flagged = anomaly.ema_anomaly(recent.select(*cols), carry_in=kept, order=ORDER)
    agg = windows.zone_window_agg(recent, expected=windows.expected_meters(readings(spark, sf)))
    joined = agg.join(windows.anomaly_counts(flagged), ["zone_id", "window_start_ts"], "left")
    return dashboards.live_kpis(joined.withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(0))))


@query
def fleet_status_states(spark, sf):
    return dashboards.fleet_status_states(_stg(spark, sf))


@query
def fleet_status_zone_kwh(spark, sf):
    return dashboards.fleet_status_zone_kwh(_stg(spark, sf))


@query
def fleet_status_totals(spark, sf):
    return dashboards.fleet_status_totals(_stg(spark, sf))


@query
def fleet_composition(spark, sf):
    return dashboards.fleet_composition(_stg(spark, sf))


# --- analyses ----------------------------------------------------------------

@query
def dim_meter(spark, sf):
    return analysis.dim_meter(readings(spark, sf), ORDER)


@query
def absent_meters(spark, sf):
    r = readings(spark, sf)
    return analysis.absent_meters(r, analysis.dim_meter(r, ORDER))


@query
def expected_throughput(spark, sf):
    return analysis.expected_throughput(analysis.dim_meter(readings(spark, sf), ORDER))


@query
def reading_completeness(spark, sf):
    return analysis.reading_completeness(readings(spark, sf))


@query
def scenario_tagged(spark, sf):
    return analysis.tag_scenarios(readings(spark, sf)).select(
        "event_id", "zone_id", "reading_ts", "scenario")


@query
def scenario_calendar(spark, sf):
    """Readings under a calendar of one entry for each tenth reading: in its zone, or in all."""
    r = readings(spark, sf)
    n = F.col("arrival_seq")
    calendar = r.filter(n % 10 == 0).select(
        F.concat(F.lit("job-"), (n % 70).cast("string")).alias("scenario"),
        F.when(n % 50 == 0, "ALL").otherwise(F.col("zone_id")).alias("zone_id"),
        F.col("reading_ts").alias("start_ts"),
        (F.col("reading_ts") + F.make_dt_interval(F.lit(0), F.lit(0), (n % 1500).cast("int"))).alias("end_ts"))
    tagged = analysis.with_calendar(r.select("event_id", "zone_id", "reading_ts"), calendar)
    return tagged.select("event_id", F.size("scenarios").cast("long").alias("n_scenarios"),
                         F.array_join("scenarios", ",").alias("scenarios"))


@query
def active_meters_any_range(spark, sf):
    """Meters per zone and day, and per day over all zones, from window sketches: are they near the exact number?"""
    r = readings(spark, sf)
    kept = materialise(windows.meter_sketches(r), "sketches").withColumn("day", F.col("window_start_ts").cast("date"))
    of_zone = windows.merged_meters(kept, "zone_id", "day")
    of_all = windows.merged_meters(kept, "day").withColumn("zone_id", F.lit("ALL")).select(of_zone.columns)
    exact = r.select("zone_id", F.col("reading_ts").cast("date").alias("day"), "meter_id")
    counted = exact.groupBy("zone_id", "day").agg(F.count_distinct("meter_id").alias("active_meters")).unionByName(
        exact.groupBy("day").agg(F.count_distinct("meter_id").alias("active_meters")).withColumn("zone_id", F.lit("ALL")))
    error = 4 * 1.04 / 2 ** (windows.SKETCH_BITS / 2)  # four standard errors
    near = F.abs(F.col("meters") - F.col("active_meters")) <= error * F.col("active_meters") + 1
    return of_zone.unionByName(of_all).join(counted, ["zone_id", "day"]).select(
        "zone_id", "day", "active_meters", near.alias("is_near"))


@query
def scenario_impact(spark, sf):
    return analysis.scenario_impact(readings(spark, sf))


@query
def peak_offpeak(spark, sf):
    return analysis.peak_offpeak(_stg(spark, sf))


@query
def load_latency(spark, sf):
    return analysis.load_latency(_stg(spark, sf))


# --- streams, drained to a table ---------------------------------------------

def _window_log(spark: SparkSession, sf: str) -> str:
    out = scratch_path(spark, "window-log")
    stream = replay_readings(spark, sf)
    start_window_log(stream, out, scratch_path(spark, "offsets")).awaitTermination()
    return out


def _flag_log(spark: SparkSession, sf: str) -> str:
    out = scratch_path(spark, "flags")
    stream = replay_readings(spark, sf)
    stream_anomaly.start_ema_anomaly(stream, out, scratch_path(spark, "offsets")).awaitTermination()
    return out


@query
def stream_zone_windows(spark, sf):
    expected = windows.expected_meters(readings(spark, sf))
    return read_windows(spark, _window_log(spark, sf), expected=expected)


@query
def stream_zone_delta(spark, sf):
    return read_window_deltas(spark, _window_log(spark, sf)).select(
        "zone_id", "window_start_ts", "total_kwh", "demand_vs_prev_window_pct")


@query
def stream_ema_anomaly(spark, sf):
    return spark.read.parquet(_flag_log(spark, sf)).select(
        "event_id", "meter_id", "reading_ts", "is_anomaly_ema")


@query
def stream_ema_seeded(spark, sf):
    """As `ema_carried`, the second load being a stream that begins in the baselines of the first."""
    r = readings(spark, sf)
    early = F.col("reading_ts") < F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz")
    first = materialise(anomaly.ema_anomaly(r.filter(early), order=ORDER), "first-load")
    path, out = scratch_path(spark, "second-load"), scratch_path(spark, "flags")
    r.filter(~early).write.parquet(path)
    stream_anomaly.start_ema_anomaly(
        spark.readStream.schema(r.schema).parquet(path), out, scratch_path(spark, "offsets"),
        seed=anomaly.ema_baselines(first, ORDER)).awaitTermination()
    cols = ["event_id", "meter_id", "reading_ts", "is_anomaly_ema"]
    return first.select(*cols).unionByName(spark.read.parquet(out).select(*cols))


@query
def stream_silence_alarms(spark, sf):
    """Pauses told while they last: those that ended, and of meters still silent the one that is their last."""
    out = scratch_path(spark, "alarms")
    start_silence_alarms(replay_readings(spark, sf), out, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out).select("meter_id", "zone_id", "silent_from")


def _live(spark: SparkSession, sf: str, *slices: DataFrame) -> str:
    """Run the live path over JSON messages, a micro-batch for each slice, and return its folder."""
    topic, out = scratch_path(spark, "topic"), scratch_path(spark, "live")
    for i, values in enumerate(slices):
        values.write.text(f"{topic}/{i}")
        stream = read_stream(spark, "files", path=f"{topic}/*", keyed=False)
        run_live(stream, out, f"{out}-offsets").awaitTermination()
    return out


@query
def stream_zone_full(spark, sf):
    r = readings(spark, sf)
    out = _live(spark, sf, src.as_json(r.withColumn("kwh_reading", F.lit(0.0))))
    return read_window_deltas(
        spark, f"{out}/parts", expected=windows.expected_meters(r), with_anomalies=True)


@query
def live_pipeline(spark, sf):
    """Messages with unusable ones among them, through flags and parts to the windows."""
    r = readings(spark, sf)
    out = _live(spark, sf, src.bad_json(r).select("value"))
    expected = windows.expected_meters(r.filter("k > 3"))
    return read_window_deltas(spark, f"{out}/parts", expected=expected, with_anomalies=True)


@query
def stream_dead_letters(spark, sf):
    out = _live(spark, sf, src.bad_json(readings(spark, sf)).select("value"))
    return spark.read.parquet(f"{out}/dead").groupBy("reason").agg(F.count("*").alias("messages"))


@query
def live_redelivered(spark, sf):
    """Every message twice, the second time in a later micro-batch too: the windows are those of one."""
    values = src.bad_json(readings(spark, sf)).select("value", "k")
    times = F.when(F.col("k") % 2 == 0, 2).otherwise(1)
    twice = values.select(F.explode(F.array_repeat("value", times)).alias("value"))  # each text is made once
    out = _live(spark, sf, twice, values.select("value"))
    return read_window_deltas(spark, f"{out}/parts", with_anomalies=True)


@query
def live_accounts(spark, sf):
    """Messages that came twice, of each zone: all are dead, copies or accepted, and none is late."""
    values = src.bad_json(readings(spark, sf)).select("value")
    out = _live(spark, sf, values, values)
    counts = ["messages", "dead", "copies", "accepted", "late"]
    return spark.read.parquet(f"{out}/accounts").groupBy("zone_id").agg(*[F.sum(c).alias(c) for c in counts])


@query
def live_closed(spark, sf):
    """Closed windows of a stream in which one zone is an hour behind the others: it loses nothing."""
    r = readings(spark, sf)
    lo, hi = r.agg(F.min("reading_ts"), F.max("reading_ts")).first()
    behind = F.when(F.col("zone_id") == "ZONE-SOUTH", F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    seen = F.col("reading_ts") + behind
    ends = [F.lit(lo + (hi - lo) * i / 3).cast("timestamp_ntz") for i in (1, 2)]
    slice_no = F.when(seen < ends[0], 0).when(seen < ends[1], 1).otherwise(2)
    out = _live(spark, sf, *[src.as_json(r.filter(slice_no == i).withColumn("kwh_reading", F.lit(0.0))) for i in range(3)])
    late = spark.read.parquet(f"{out}/accounts").agg(F.sum("late").alias("late"))
    return spark.read.parquet(f"{out}/closed").crossJoin(late).select(  # one row of counts
        "zone_id", "window_start_ts", "total_kwh", "active_meter_count", "demand_vs_prev_window_pct", "late")


@query
def closed_windows(spark, sf):
    out = scratch_path(spark, "closed")
    closed = stream_closed_windows(replay_readings(spark, sf))
    start_log(closed, out, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.parquet(out).drop("batch_id")
