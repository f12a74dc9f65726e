"""Ordered operators on skewed keys, against plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meterflow.functions.times import hour_start
from meterflow.operators import analysis, anomaly, windows
from meterflow.operators.ordered import running_by_slot

START = dt.datetime(2024, 1, 1)
COLS = ("event_id string, meter_id string, zone_id string, customer_type string, "
        "reading_ts timestamp_ntz, kwh_delta double, kwh_reading double, meter_state string, seq long")
ORDER = ("reading_ts", "seq")


def skewed_rows(n=3000, seed=5):
    """Readings of ten meters; one of them has half of all rows."""
    rng = random.Random(seed)
    rows, now = [], START
    for i in range(n):
        now += dt.timedelta(seconds=rng.choice([0, 1, 30, 600]))
        meter = "HOT" if rng.random() < 0.5 else f"M{rng.randrange(9)}"
        kwh = round(rng.lognormvariate(-1, 1.2), 4) if rng.random() > 0.05 else 0.0
        state = rng.choices(["normal", "degraded", "fault", "silent"], [6, 2, 2, 1])[0]
        rows.append((str(i), meter, "ZONE-EAST", "residential", now, kwh, float(rng.randrange(100)),
                     state, i))
    return rows


ROWS = skewed_rows()


@pytest.fixture(scope="module")
def df(spark):
    shuffled = ROWS[:]
    random.Random(1).shuffle(shuffled)
    return spark.createDataFrame(shuffled, COLS).repartition(5).cache()


def by_meter():
    out = defaultdict(list)
    for r in ROWS:
        out[r[1]].append(r)
    return out


def python_ema(rows, start=None):
    """Flags by event id and the last baselines, one reading after the other."""
    base, flags = dict(start or {}), {}
    for r in rows:
        key = (r[1], r[4].hour)
        if key not in base:
            base[key], flags[r[0]] = r[5], False
        else:
            flags[r[0]] = base[key] > 0 and r[5] > base[key] * 4.0
            if not flags[r[0]]:
                base[key] = 0.2 * r[5] + (1 - 0.2) * base[key]
    return flags, base


def test_ema_equals_one_long_run(df):
    want, base = python_ema(ROWS)
    got = anomaly.ema_anomaly(df, order=ORDER)
    assert {r.event_id: r.is_anomaly_ema for r in got.collect()} == want
    last = anomaly.ema_baselines(got, ORDER).collect()
    assert {(r.meter_id, r.ema_hour): r.ema_baseline for r in last} == base


def test_ema_continues_from_carried_baselines(df):
    half = len(ROWS) // 2
    first = anomaly.ema_anomaly(df.filter(F.col("seq") < half), order=ORDER)
    carried = anomaly.ema_baselines(first, ORDER)
    second = anomaly.ema_anomaly(df.filter(F.col("seq") >= half), carry_in=carried, order=ORDER)
    want, _ = python_ema(ROWS)
    got = {r.event_id: r.is_anomaly_ema for r in first.unionByName(second).collect()}
    assert got == want


def test_ema_hand_worked(spark):
    def flags(values):
        rows = [(str(i), "A", "Z", "residential", START + dt.timedelta(minutes=i), x, 0.0, "normal", i)
                for i, x in enumerate(values)]
        out = anomaly.ema_anomaly(spark.createDataFrame(rows, COLS), order=ORDER)
        got = sorted(out.collect(), key=lambda r: r.seq)
        return [r.is_anomaly_ema for r in got], [round(r.ema_baseline, 9) for r in got]

    assert flags([1.0, 4.0, 6.5, 1.6]) == ([False, False, True, False], [1.0, 1.6, 1.6, 1.6])
    assert flags([0.0, 5.0]) == ([False, False], [0.0, 1.0])


def test_ema_keeps_rows_without_energy(spark):
    rows = [("0", "A", "Z", "residential", START, 1.0, 0.0, "normal", 0),
            ("1", "A", "Z", "residential", START, None, 0.0, "normal", 1),
            ("2", "A", "Z", "residential", START, 5.0, 0.0, "normal", 2)]
    out = anomaly.ema_anomaly(spark.createDataFrame(rows, COLS), order=ORDER).collect()
    assert {r.event_id: r.is_anomaly_ema for r in out} == {"0": False, "1": False, "2": True}


def test_baseline_of_unseen_hour_is_zero(spark):
    seen = spark.createDataFrame([("A", 3, 1.5)], "meter_id string, ema_hour int, ema_baseline double")
    wanted = spark.createDataFrame([("A", 3), ("A", 4)], "meter_id string, ema_hour int")
    got = {r.ema_hour: r.ema_baseline for r in anomaly.baseline_for_hour(seen, wanted).collect()}
    assert got == {3: 1.5, 4: 0.0}


def test_rolling_anomaly(df):
    want = {}
    for rows in by_meter().values():
        units = [round(r[5] * 10000) for r in rows]
        for i, r in enumerate(rows):
            before = units[max(0, i - 12):i]
            want[r[0]] = bool(sum(before)) and units[i] * len(before) > 3 * sum(before)
    got = anomaly.rolling_anomaly(df, order=ORDER).collect()
    assert {r.event_id: r.is_anomaly_rolling for r in got} == want


@pytest.mark.parametrize("how", ["sum", "max"])
def test_running_by_slot(df, how):
    want = {}
    for rows in by_meter().values():
        total = None
        for r in rows:
            total = r[8] if total is None else total + r[8] if how == "sum" else max(total, r[8])
            want[r[0]] = total
    out = running_by_slot(df, ["meter_id"], ORDER, hour_start(F.col("reading_ts")), "seq", "x", how)
    assert {r.event_id: r.x for r in out.collect()} == want


def test_odometer_breaks(df):
    want = {r[0] for rows in by_meter().values() for p, r in zip(rows, rows[1:]) if r[6] < p[6]}
    assert {r.event_id for r in analysis.odometer_breaks(df, ORDER).collect()} == want


def test_state_transitions(df):
    want = defaultdict(int)
    for rows in by_meter().values():
        for p, r in zip(rows, rows[1:]):
            want[(p[7], r[7])] += 1
    got = analysis.state_transitions(df, ORDER).collect()
    assert {(r.from_state, r.to_state): r.transitions for r in got} == want
    legal = {(r.from_state, r.to_state): r.is_legal for r in got}
    assert legal[("normal", "degraded")] and not legal[("normal", "fault")]


def test_fault_episodes(df):
    want = []
    for meter, rows in by_meter().items():
        run = []
        for r in [*rows, None]:
            if run and (r is None or r[7] != run[-1][7]):
                if run[0][7] != "normal":
                    want.append((meter, run[0][7], run[0][4], run[-1][4], len(run)))
                run = []
            run.append(r)
    got = [tuple(r)[:5] for r in analysis.fault_episodes(df, ORDER).collect()]
    assert sorted(got) == sorted(want)


def test_silence_gaps(df):
    want = [(meter, p[4], r[4]) for meter, rows in by_meter().items()
            for p, r in zip(rows, rows[1:]) if (r[4] - p[4]).total_seconds() > 900]
    got = [(r.meter_id, r.silent_from, r.silent_to)
           for r in analysis.silence_gaps(df, order=ORDER).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("per_slot", [1_000_000, 64])
def test_arrival_windows_equal_the_loop(spark, monkeypatch, per_slot):
    monkeypatch.setattr(windows, "ARRIVALS_PER_SLOT", per_slot)
    rng = random.Random(3)
    rows, want, opened = [], defaultdict(float), {}
    for i in range(1000):
        at = START + dt.timedelta(seconds=max(0, i * 20 + rng.choice([0, 0, -400, -1500])))
        zone = rng.choice(["ZONE-EAST", "ZONE-EAST", "ZONE-WEST"])
        rows.append((i, "A", zone, at, 1.0))
        start = at - dt.timedelta(seconds=at.minute * 60 % 300 + at.second)
        if zone not in opened or at >= opened[zone] + dt.timedelta(seconds=300):
            opened[zone] = start
        want[(zone, opened[zone])] += 1.0
    df = spark.createDataFrame(
        rows, "arrival long, meter_id string, zone_id string, reading_ts timestamp_ntz, kwh_delta double")
    measures = ["power_kw", "power_factor", "voltage", "frequency_hz"]
    df = df.withColumns({m: F.lit(1.0) for m in measures}).withColumn("meter_state", F.lit("normal"))
    got = windows.zone_window_agg(df.repartition(4), late="arrival", order=("arrival",)).collect()
    assert {(r.zone_id, r.window_start_ts): r.total_kwh for r in got} == dict(want)


def test_running_total_of_null_keys(spark):
    rows = [(None, START, 1, 0), (None, START + dt.timedelta(hours=1), 2, 1), ("A", START, 4, 2), (None, None, 8, 3)]
    df = spark.createDataFrame(rows, "meter_id string, reading_ts timestamp_ntz, units long, seq long")
    out = running_by_slot(df, ["meter_id"], ORDER, hour_start(F.col("reading_ts")), "units", "total")
    assert {r.seq: r.total for r in out.collect()} == {3: 8, 0: 9, 1: 11, 2: 4}


def _series(kind, n=2400):
    pick = random.Random(kind)
    if kind == "tied":  # constant readings, and others that are just the threshold times the baseline
        return [0.9 if i % 7 == 3 else 0.3 for i in range(n)]
    if kind == "flagged":  # after the first, none is below the threshold
        return [1.0] + [10.0 + i for i in range(n - 1)]
    if kind == "gaps":
        return [None if pick.random() < 0.5 else pick.choice([0.0, -1.0, 0.2, 0.7, 2.0, 50.0]) for _ in range(n)]
    if kind == "missing":
        return [None] * (n - 1) + [1.0]
    return [round(pick.expovariate(2), 4) for _ in range(n)]


@pytest.mark.parametrize(
    "kind, carried", [("usual", False), ("tied", True), ("flagged", True), ("gaps", False), ("missing", True)])
def test_a_hot_meter_runs_in_stretches_with_the_same_result(spark, kind, carried):
    """One meter has most readings, all in one hour; cut into nine stretches, every bit is as in one run."""
    rows = [(f"{i:06d}", "hot", START + dt.timedelta(seconds=i), x) for i, x in enumerate(_series(kind))]
    rows += [(f"n{i:05d}", None, START + dt.timedelta(seconds=7 * i), float(i % 5)) for i in range(300)]
    rows += [(f"c{i:05d}", f"m{i % 9}", START + dt.timedelta(minutes=i), float(i % 4)) for i in range(900)]
    df = spark.createDataFrame(rows, COLS_E).repartition(5)
    starts = spark.createDataFrame([("hot", 0, 0.25), ("m1", 0, 9.0), ("hot", 1, 3.0), ("new", 5, 1.0)],
                                   "meter_id string, ema_hour int, ema_baseline double") if carried else None
    run = lambda stretch: sorted(
        (r.event_id, r.is_anomaly_ema, r.ema_baseline, r.meter_id, r.kwh_delta)
        for r in anomaly.ema_anomaly(df, carry_in=starts, stretch=stretch, order=("reading_ts", "event_id")).collect())
    got = run(400)
    assert got == run(10**9) and len(got) == len(rows)


COLS_E = "event_id string, meter_id string, reading_ts timestamp_ntz, kwh_delta double"
