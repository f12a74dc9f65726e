"""State of streams: kept tables, logs by day, silence, and the live path over restarts."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from meterflow.operators import anomaly
from meterflow.streaming.anomaly import start_ema_anomaly
from meterflow.streaming.live import LiveTables, read_live_windows, run_live
from meterflow.streaming.silence import start_silence_alarms
from meterflow.streaming.sources import read_stream
from meterflow.streaming.state import DayLog, Kept

DAY = dt.datetime(2024, 1, 1)


def at(minutes=0, seconds=0):
    return DAY + dt.timedelta(minutes=minutes, seconds=seconds)


def test_kept_rows_are_the_latest_and_a_batch_can_run_again(spark, tmp_path):
    kept = Kept(str(tmp_path / "k"), "k string, v int, w string", ["k"], every=3)
    kept.seed(spark, spark.createDataFrame([("seed", 0, "s"), ("a", -1, "s")], kept.schema))
    want = {"seed": (0, "s"), "a": (-1, "s")}
    for i in range(8):
        rows = [("a", i, None), (f"b{i % 2}", i, str(i)), (None, i, "null key")]
        assert {r.k: (r.v, r.w) for r in kept.before(spark, i).collect()} == want
        for part in ([("a", 99, "lost")], rows):  # the first try of the batch was cut off
            kept.put(spark.createDataFrame(part, kept.schema), i)
        want |= {k: (v, w) for k, v, w in rows}
    assert {r.k: (r.v, r.w) for r in kept.before(spark, 8).collect()} == want


def test_a_log_merges_days_and_opens_only_those_asked_for(spark, tmp_path):
    log = DayLog(str(tmp_path / "log"), "ts timestamp_ntz, n long", "ts", merge_from=3)
    log.seed(spark)
    total = lambda rows: rows.groupBy("ts").agg(F.sum("n").alias("n"))
    hours = spark.createDataFrame([(DAY,)], "hour timestamp_ntz")
    old = None
    for i in range(7):
        rows = [(DAY, 1), (DAY + dt.timedelta(hours=2), 100), (DAY + dt.timedelta(days=i), 10)]
        log.write(spark.createDataFrame(rows, log.schema), i)
        log.publish(spark, i, total)
        log.publish(spark, i, total)
        got = log.read(spark, i + 1, hours)
        assert got.agg(F.sum("n")).first()[0] == i + 1 + 10
        assert all("_day=d20240101" in f for f in got.inputFiles())
        assert len({f.rsplit("/", 1)[0] for f in got.inputFiles()}) < 3 or i < 2
        old = old or got
    assert old.agg(F.sum("n")).first()[0] == 11  # a reader of the first index
    assert spark.read.parquet(log.path).agg(F.sum("n")).first()[0] == 7 * 111
    whole = log.read_between(spark, 7, DAY, DAY + dt.timedelta(days=9))
    assert whole.agg(F.sum("n")).first()[0] == 7 * 111
    assert log.read(spark, 7, hours.limit(0)).isEmpty() and log.read_between(spark, 7, None, None).isEmpty()


READINGS = "meter_id string, zone_id string, customer_type string, reading_ts timestamp_ntz"


def test_silence_is_told_once_while_it_lasts_and_over_restarts(spark, tmp_path):
    """Limits: 900 s for residential, 180 s for industrial meters."""
    def reading(meter, minutes, kind="residential"):
        return (meter, "Z", kind, at(minutes))

    loads = [
        [reading("seen", 0)],                                     # before the stream
        [reading("a", 0), reading("a", 5), reading("b", 0), reading("c", 2, "industrial"), reading("c", 4, "industrial"),
         reading("d", 40), reading("d", 20), reading("d", 21)],   # d pauses inside a batch, and comes out of order
        [reading("e", 41)],                                       # a, b, c and the one seen before are silent by now
        [reading("a", 60), reading("a", 50), reading("b", 14)],   # a is back, b's is too late
        [reading("e", 61)],
    ]
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    told = []
    for i, rows in enumerate(loads[1:]):
        spark.createDataFrame(rows, READINGS).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(READINGS).parquet(path)
        seed = spark.createDataFrame(loads[0], READINGS)
        start_silence_alarms(stream, out, mark, seed=seed if i == 0 else None).awaitTermination()
        told.append({(r.meter_id, r.silent_from) for r in spark.read.parquet(out).collect()})
    assert told[1] >= {("a", at(5)), ("b", at(0)), ("c", at(4)), ("d", at(21)), ("seen", at(0))}
    assert told[2] - told[1] == {("d", at(40)), ("e", at(41))} and told[3] == told[2]
    rows = spark.read.parquet(out).collect()
    assert len(rows) == len(told[-1]) and Counter(r.meter_id for r in rows) == {
        "a": 1, "b": 1, "c": 1, "d": 2, "e": 1, "seen": 1}


def test_a_seeded_stream_passes_readings_without_energy(spark, tmp_path):
    schema = ("event_id string, meter_id string, zone_id string, reading_ts timestamp_ntz, kwh_delta double, voltage double, "
              "power_kw double, power_factor double, frequency_hz double, meter_state string, arrival_seq long")

    def reading(i, kwh):
        return (str(i), "m", "Z", at(i), kwh, 120.0, 1.0, 0.9, 60.0, "normal", i)

    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    seed = spark.createDataFrame([("m", 0, 1.0)], "meter_id string, ema_hour int, ema_baseline double")
    for rows in ([reading(0, None), reading(1, 4.5)], [reading(2, None)], [reading(3, 3.0), reading(4, 5.7)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        start_ema_anomaly(stream, out, mark, seed=seed).awaitTermination()
    got = {r.event_id: (r.is_anomaly_ema, r.ema_baseline) for r in spark.read.parquet(out).collect()}
    # 4.5 is over four times 1; 3.0 makes it 1.4, and 5.7 is over four times that
    assert {k: v[0] for k, v in got.items()} == {"0": False, "1": True, "2": False, "3": False, "4": True}
    assert got["2"][1] == 1.0 and got["3"][1] == pytest.approx(1.4)


def message(i, zone, minutes, meter="m", seconds=0):
    ts = at(minutes, seconds).strftime("%Y-%m-%dT%H:%M:%SZ")
    return (f'{{"event_id":"{i}","meter_id":"{meter}","zone_id":"{zone}","timestamp":"{ts}","kwh_delta":1.0,"power_kw":1.0,'
            f'"voltage":120.0,"power_factor":0.9,"frequency_hz":60.0,"meter_state":"normal"}}',)


def test_zones_close_by_their_own_clocks(spark, tmp_path):
    """Hand-worked: zone S is an hour behind N; copies and late readings are counted, and nothing of S is lost."""
    topic, out, mark = (str(tmp_path / n) for n in ("topic", "out", "mark"))
    batches = [
        [message(1, "N", 60), message(2, "N", 66), message(3, "S", 1), message(4, "S", 2), ("{",)],
        [message(5, "N", 71), message(2, "N", 66), message(6, "N", 61), message(7, "S", 3), message(7, "S", 3)],
        [message(8, "S", 11), message(9, "S", 12), message(10, "N", 200)],
    ]
    pushed = []
    for rows in batches:
        spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(topic)
        run_live(read_stream(spark, "files", path=topic), out, mark,
                 deliver=lambda df, i: pushed.extend((i, r.zone_id, r.window_start_ts[11:16], r.total_kwh,
                                                      r.demand_vs_prev_window_pct) for r in df.collect())).awaitTermination()
    closed = {(r.zone_id, r.window_start_ts): (r.total_kwh, r.demand_vs_prev_window_pct, r.batch_id)
              for r in spark.read.parquet(f"{out}/closed").collect()}
    assert closed == {
        ("N", at(60)): (1.0, None, 0), ("N", at(65)): (1.0, 0.0, 1), ("N", at(70)): (1.0, 0.0, 2),
        ("S", at(0)): (3.0, None, 2)}
    counts = {(r.batch_id, r.zone_id): (r.messages, r.dead, r.copies, r.accepted, r.late)
              for r in spark.read.parquet(f"{out}/accounts").collect()}
    assert counts == {(0, None): (1, 1, 0, 0, 0), (0, "N"): (2, 0, 0, 2, 0), (0, "S"): (2, 0, 0, 2, 0),
                      (1, "N"): (3, 0, 1, 2, 1), (1, "S"): (2, 0, 1, 1, 0),
                      (2, "N"): (1, 0, 0, 1, 0), (2, "S"): (2, 0, 0, 2, 0)}
    # a window that a batch touches is pushed as a whole; the one before it may be in no hour touched
    assert sorted(p for p in pushed if p[0] == 1) == [(1, "N", "01:00", 2.0, 0.0), (1, "N", "01:10", 1.0, 0.0),
                                                      (1, "S", "00:00", 3.0, 0.0)]
    assert (2, "N", "03:20", 1.0, 0.0) in pushed and (2, "S", "00:10", 2.0, -33.33) in pushed
    hours = spark.createDataFrame([(at(60),)], "hour timestamp_ntz")
    board = {(r.zone_id, r.window_start_ts): r.total_kwh for r in read_live_windows(spark, out, 2, hours).collect()}
    assert board == {("N", at(60)): 2.0, ("N", at(65)): 1.0, ("N", at(70)): 1.0}


def test_redelivered_messages_and_a_batch_that_runs_again(spark, tmp_path):
    """Forty messages, each delivered twice, over a restart: their energy counts once."""
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    rows = [message(i, "N", i % 7, f"m{i % 3}") for i in range(40)]
    for part in (rows[:25] + rows[:5], rows[10:], rows):
        spark.createDataFrame(part, "value string").coalesce(1).write.mode("append").text(topic)
        run_live(read_stream(spark, "files", path=topic), out, str(tmp_path / "mark")).awaitTermination()
    assert spark.read.parquet(f"{out}/flags").count() == 40
    assert spark.read.parquet(f"{out}/parts").agg(F.sum("units")).first()[0] == 400_000
    # the whole topic as one first batch again, as after a lost checkpoint: its folders are replaced
    run_live(read_stream(spark, "files", path=topic), str(tmp_path / "again"), str(tmp_path / "mark2")).awaitTermination()
    again = LiveTables(str(tmp_path / "again"))
    assert again.flags.of_batch(spark, 0).count() == 40
    assert anomaly.ema_baselines(again.flags.of_batch(spark, 0), ("reading_ts", "arrival_seq")).count() == 3
