"""Streams: restart, late rows, copies, routing, and the hourly load."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from meterflow.operators import anomaly, routing, windows
from meterflow.plans.hourly_load import (
    MARTS, ChecksFailed, build_marts, read_marts, read_rejected, read_staging, run_hourly_load,
)
from meterflow.operators.staging import staging_from_readings
from meterflow.sources import archive, raw
from meterflow.sources.readings import (
    EVENTS_SCHEMA, ORDER, as_json, bad_json, from_events, out_of_order, readings, with_faults, with_odometer,
)
from meterflow.storage import scratch_path
from meterflow.streaming.anomaly import start_ema_anomaly
from meterflow.streaming.live import run_live
from meterflow.streaming.sinks import (
    read_latest, start_archive, start_log, start_push, start_routed,
)
from meterflow.streaming.sources import parse_messages, read_stream
from meterflow.streaming.windows import closed_windows, read_windows, start_window_log


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def halves(spark, sf, tmp_path):
    """A folder that gets the first half of the events, and a function adding the second."""
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf}/events.parquet")
    path = str(tmp_path / "in")

    def add(part):
        cut = F.col("event_id") < 500
        events.filter(cut if part == 1 else ~cut).coalesce(1).write.mode("append").parquet(path)

    add(1)
    stream = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return from_events(stream), lambda: add(2)


def test_window_log_survives_a_restart(spark, sf, halves, tmp_path):
    stream, add_rest = halves
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    start_window_log(stream, out, mark).awaitTermination()
    add_rest()
    start_window_log(stream, out, mark).awaitTermination()
    assert same(read_windows(spark, out), windows.zone_window_agg(readings(spark, sf)))


def test_ema_state_survives_a_restart(spark, sf, halves, tmp_path):
    stream, add_rest = halves
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    start_ema_anomaly(stream, out, mark).awaitTermination()
    add_rest()
    start_ema_anomaly(stream, out, mark).awaitTermination()
    want = anomaly.ema_anomaly(readings(spark, sf), order=ORDER)
    cols = ["event_id", "is_anomaly_ema", "ema_baseline"]
    assert same(spark.read.parquet(out).select(*cols), want.select(*cols))


def test_closed_windows_are_given_out_once(spark, sf, halves, tmp_path):
    stream, add_rest = halves
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    add_rest()
    start_log(closed_windows(stream), out, mark).awaitTermination()
    r = readings(spark, sf)
    newest = r.agg(F.max("reading_ts")).first()[0]
    want = windows.zone_window_agg(r).filter(
        F.col("window_end_ts") <= F.lit(newest - dt.timedelta(minutes=10)).cast("timestamp_ntz"))
    assert same(spark.read.parquet(out).drop("batch_id"), want)


def test_late_rows_count_in_their_own_window(spark, tmp_path):
    """The log takes a row of any age; the closed windows drop it."""
    def event(i, minute):
        return (i, dt.datetime(2024, 1, 1, 10, minute), 1, "view", 100.0, '{"k": 30}')

    path = str(tmp_path / "in")
    for i, minute in enumerate([0, 40, 1]):
        spark.createDataFrame([event(i, minute)], EVENTS_SCHEMA).coalesce(1).write.mode(
            "append").parquet(path)
        stream = from_events(spark.readStream.schema(EVENTS_SCHEMA).parquet(path))
        start_window_log(stream, str(tmp_path / "log"), str(tmp_path / "m1")).awaitTermination()
        start_log(closed_windows(stream), str(tmp_path / "closed"),
                  str(tmp_path / "m2")).awaitTermination()
    first = dt.datetime(2024, 1, 1, 10)
    logged = read_windows(spark, str(tmp_path / "log")).filter(F.col("window_start_ts") == first)
    assert logged.first().total_kwh == 2.0
    closed = spark.read.parquet(str(tmp_path / "closed"))
    assert [(r.window_start_ts, r.total_kwh) for r in closed.collect()] == [(first, 1.0)]


def test_repeated_batch_counts_once(spark, tmp_path):
    """Writing a batch again after a lost executor or driver replaces it."""
    path = f"{tmp_path}/in"
    spark.range(5).write.parquet(path)
    for run in range(2):
        stream = spark.readStream.schema("id long").parquet(path)
        start_log(stream, f"{tmp_path}/out", f"{tmp_path}/mark{run}").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_read_latest_keeps_the_newest_row_of_a_key(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    df.write.parquet(f"{tmp_path}/batch_id=9")
    df.filter("k = 'a'").withColumn("v", F.lit(7)).write.parquet(f"{tmp_path}/batch_id=10")
    got = read_latest(spark, str(tmp_path), df.schema, ["k"]).collect()
    assert {(r.k, r.v) for r in got} == {("a", 7), ("b", 2)}


def test_stream_drops_copies(spark, sf, halves, tmp_path):
    stream, _ = halves
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    start_log(raw.dedup(twice, "1 hour"), f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 500


def test_one_pass_writes_both_topics(spark, sf, halves, tmp_path):
    stream, _ = halves
    routed = routing.route_alerts(stream).select("event_id", "event_type", "topic", "partition")
    start_routed(routed, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    alerts = out.filter(F.col("topic") == "meter.alerts")
    assert out.filter(F.col("topic") == "meter.readings").count() == 500
    assert alerts.count() == out.filter("topic = 'meter.readings' and event_type = 'alert'").count()


def test_streamed_archive_is_partitioned_by_hour(spark, halves, tmp_path):
    stream, _ = halves
    text = archive.with_hour_parts(stream).select("event_id", *archive.HOUR_COLS)
    start_archive(text, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    back = spark.read.json(f"{tmp_path}/out")
    assert back.count() == 500 and set(archive.HOUR_COLS) <= set(back.columns)


def test_push_hands_over_rows(spark, halves, tmp_path):
    stream, _ = halves
    seen = []
    rows = stream.select("event_id")
    pushing = start_push(rows, lambda batch, i: seen.append(batch.count()), f"{tmp_path}/mark")
    pushing.processAllAvailable()
    pushing.stop()
    assert sum(seen) == 500


def test_bad_messages_do_not_stop_a_stream(spark, sf, tmp_path):
    good = as_json(with_odometer(readings(spark, sf)).limit(3))
    bad = spark.createDataFrame([("{",), ('{"meter_id": 1}',), ("",)], "value string")
    good.union(bad).write.text(f"{tmp_path}/in")
    parsed = parse_messages(read_stream(spark, "files", path=f"{tmp_path}/in"))
    start_log(parsed, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError):
        read_stream(spark, "pigeon")


# --- the hourly load ---------------------------------------------------------

HOURS = (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6))


@pytest.fixture
def raw_path(spark, sf, tmp_path):
    day = readings(spark, sf).filter(F.to_date("reading_ts") == F.lit("2024-01-05").cast("date"))
    path = str(tmp_path / "raw")
    archive.write_archive(as_json(with_odometer(day), ["reading_ts"]), path, fmt="text")
    return path


def test_hourly_load_builds_the_marts(spark, sf, raw_path, tmp_path):
    stamp = F.lit("2024-01-06").cast("timestamp_ntz")
    for _ in range(2):  # a second run of the same hours changes nothing
        built = run_hourly_load(spark, raw_path, str(tmp_path / "out"), HOURS, stamp)
    assert set(built) == set(MARTS)
    day = readings(spark, sf).filter(F.to_date("reading_ts") == F.lit("2024-01-05").cast("date"))
    want = MARTS["mart_zone_daily"](staging_from_readings(day))
    assert same(built["mart_zone_daily"], want)


def test_hourly_load_waits_for_files(spark, raw_path, tmp_path):
    later = (dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2))
    assert run_hourly_load(spark, raw_path, str(tmp_path / "out"), later) is None


def test_hourly_load_skips_broken_lines(spark, raw_path, tmp_path):
    (tmp_path / "raw/year=2024/month=01/day=05/hour=00").mkdir(parents=True, exist_ok=True)
    (tmp_path / "raw/year=2024/month=01/day=05/hour=00/broken.txt").write_text('{"meter_id": \n')
    assert run_hourly_load(spark, raw_path, str(tmp_path / "out"), HOURS) is not None
    assert [r.reason for r in read_rejected(spark, str(tmp_path / "out/staging")).collect()] == ["bad_json"]


def test_overlapping_loads_count_once(spark, raw_path, tmp_path):
    out, noon = str(tmp_path / "out"), dt.datetime(2024, 1, 5, 12)
    run_hourly_load(spark, raw_path, out, (HOURS[0], noon))
    run_hourly_load(spark, raw_path, out, HOURS)
    ids = [r.event_id for r in read_staging(spark, f"{out}/staging").select("event_id").collect()]
    whole = run_hourly_load(spark, raw_path, str(tmp_path / "once"), HOURS)
    assert len(ids) == len(set(ids)) == read_staging(spark, str(tmp_path / "once/staging")).count()
    assert same(read_marts(spark, f"{out}/mart")["mart_zone_daily"], whole["mart_zone_daily"])


def test_a_bad_timestamp_and_a_copy_do_not_stop_a_load(spark, raw_path, tmp_path):
    folder = tmp_path / "raw/year=2024/month=01/day=05/hour=03"
    folder.mkdir(parents=True, exist_ok=True)
    event = ('{"event_id":"x1","meter_id":"MTR-0001","zone_id":"ZONE-SOUTH","customer_type":"residential",'
             '"timestamp":"%s","kwh_delta":1.0,"power_kw":1.0,"voltage":120.0,"power_factor":0.9,'
             '"frequency_hz":60.0,"meter_state":"normal"}\n')
    good = event % "2024-01-05T03:00:01Z"
    (folder / "more.txt").write_text(good + good + event % "not-a-time" + event % "never")
    out = str(tmp_path / "out")
    run_hourly_load(spark, raw_path, out, HOURS, staging_schema="typed", mart_schema="gold")
    assert read_staging(spark, f"{out}/typed").filter("event_id = 'x1'").count() == 1
    assert [r.reason for r in read_rejected(spark, f"{out}/typed").collect()] == ["bad_timestamp"] * 2
    assert set(read_marts(spark, f"{out}/gold")) == set(MARTS)


# --- the live path -----------------------------------------------------------

def live_messages(spark, sf, path, low, high):
    part = readings(spark, sf).filter(F.col("arrival_seq").between(low, high))
    bad_json(part).coalesce(1).select("value").write.mode("append").text(path)


def test_live_path_over_batches_and_a_restart(spark, sf, tmp_path):
    topic, out, mark = (str(tmp_path / n) for n in ("topic", "out", "mark"))
    seen = []
    for low, high in ((0, 299), (300, 599), (600, 10_000)):
        live_messages(spark, sf, topic, low, high)
        run_live(read_stream(spark, "files", path=topic), out, mark,
                 deliver=lambda rows, i: seen.append((i, rows.count()))).awaitTermination()
    r = readings(spark, sf).filter("k > 3")
    want = anomaly.ema_anomaly(r, order=ORDER)
    flags = spark.read.parquet(f"{out}/flags").select("event_id", "is_anomaly_ema")
    assert same(flags, want.select("event_id", "is_anomaly_ema"))
    counted = windows.zone_window_agg(want, anomaly="is_anomaly_ema")
    assert same(read_windows(spark, f"{out}/parts", with_anomalies=True), counted)
    assert spark.read.parquet(f"{out}/dead").count() == readings(spark, sf).filter("k <= 3").count()
    assert [i for i, _ in seen] == [0, 1, 2] and all(n > 0 for _, n in seen)


def test_only_dead_letters_are_keyed_on_the_live_path(spark, tmp_path):
    """Messages that come without a key leave the same dead letters and flags, key included."""
    text = ('{"event_id":"%s","meter_id":"M","zone_id":"%s","timestamp":"2024-01-01T00:00:0%sZ","kwh_delta":1.5,'
            '"voltage":120.0,"power_factor":0.9,"power_kw":%s,"frequency_hz":60.0,"meter_state":"normal"}')
    texts = [text % (1, "A", 1, "2.0"), text % (2, "B", 2, "null"), text % (3, "C", "x", "2.0"), "{", '{"zone_id":7}']
    topic = str(tmp_path / "topic")
    spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.text(topic)
    found = {}
    for keyed in (True, False):
        messages = read_stream(spark, "files", path=topic, keyed=keyed)
        assert ("key" in messages.columns) == keyed
        out = str(tmp_path / f"out-{keyed}")
        run_live(messages, out, f"{out}-mark").awaitTermination()
        found[keyed] = [spark.read.parquet(f"{out}/{name}") for name in ("dead", "flags")]
    (dead, flags), (dead_unkeyed, flags_unkeyed) = found[True], found[False]
    assert dead_unkeyed.columns == dead.columns
    assert same(dead_unkeyed, dead) and same(flags_unkeyed, flags)
    assert sorted((r.key or "", r.reason) for r in dead_unkeyed.collect()) == [
        ("", "bad_json"), ("7", "missing_keys"), ("B", "null_required"), ("C", "bad_timestamp")]
    assert [r.event_id for r in flags_unkeyed.collect()] == ["1"]


def test_a_batch_that_runs_again_counts_once(spark, sf, tmp_path):
    """As after a lost driver: the same messages come again as the same batch."""
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    live_messages(spark, sf, topic, 0, 10_000)
    for mark in ("first", "second"):
        run_live(read_stream(spark, "files", path=topic), out, str(tmp_path / mark)).awaitTermination()
    want = readings(spark, sf).filter("k > 3")
    assert same(read_windows(spark, f"{out}/parts"), windows.zone_window_agg(want))


def test_failed_checks_leave_the_marts_alone(spark, sf, tmp_path):
    r = readings(spark, sf)
    good = build_marts(staging_from_readings(r), str(tmp_path / "mart"))
    before = good["mart_customer_segment"].collect()
    with pytest.raises(ChecksFailed) as error:
        build_marts(staging_from_readings(with_faults(r)), str(tmp_path / "mart"))
    assert {(c.check_name, c.column_name) for c in error.value.report} == {
        ("accepted_values", "zone_id"), ("not_negative", "kwh_delta")}
    assert good["mart_customer_segment"].collect() == before


def test_partition_filter_reaches_the_scan(spark, raw_path):
    lines = raw.load_raw(spark, raw_path, archive.hours_between(*HOURS))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "PartitionFilters: [(make_timestamp" in plan


def test_scratch_folder_is_the_one_of_the_session():
    session = SimpleNamespace(conf={"spark.checkpoint.dir": "/shared/place/"})
    assert scratch_path(session, "x").startswith("/shared/place/meterflow/x-")


def test_a_cluster_without_shared_folder_is_refused():
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        scratch_path(session, "x")


def test_a_load_of_one_hour_reads_that_hour_and_renews_its_day_only(spark, sf, tmp_path):
    """Marts of many loads equal a full rebuild; the day of a late hour is renewed, the others are carried over."""
    r = readings(spark, sf).filter(F.to_date("reading_ts").between("2024-01-05", "2024-01-08"))
    path, out = str(tmp_path / "raw"), str(tmp_path / "out")
    late = (F.to_date("reading_ts") == "2024-01-06") & (F.hour("reading_ts") == 13)
    archive.write_archive(as_json(with_odometer(r), ["reading_ts"]).filter(~late), path, fmt="text")
    run_hourly_load(spark, path, out, (dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 9)))
    archive.write_archive(as_json(with_odometer(r), ["reading_ts"]).filter(late), path, fmt="text")
    bad = tmp_path / "raw/year=2024/month=01/day=06/hour=13/bad.txt"
    bad.write_text("{\n")
    hour = (dt.datetime(2024, 1, 6, 13), dt.datetime(2024, 1, 6, 14))
    marts = run_hourly_load(spark, path, out, hour)
    full = build_marts(read_staging(spark, f"{out}/staging"), str(tmp_path / "full"))
    for name in MARTS:
        assert same(marts[name], full[name]), name
    partials = spark.read.parquet(f"{out}/mart-partials/meters")
    made = partials.groupBy("day", "hour").agg(F.max("made").alias("made")).collect()
    assert [(str(m.day), str(m.hour)) for m in made if m.made == max(x.made for x in made)] in ([("6", "13")], [("06", "13")])
    # the hour is loaded again without its readings: its day loses them
    folder = tmp_path / "raw/year=2024/month=01/day=06/hour=13"
    for file in folder.glob("*.txt"):
        file.write_text("")
    folder.joinpath("new.txt").write_text("{\n")
    marts = run_hourly_load(spark, path, out, hour)
    want = staging_from_readings(r.filter(~late))
    rebuilt = build_marts(want, str(tmp_path / "rest"))
    for name in MARTS:
        assert same(marts[name], rebuilt[name]), name
