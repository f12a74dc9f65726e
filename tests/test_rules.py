"""Hand-worked cases of the row rules, windows and checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterflow.functions import times
from meterflow.functions.meters import zone_partition
from meterflow.functions.numbers import round_half_up, sum_kwh
from meterflow.operators import analysis, dashboards, quality, routing, windows
from meterflow.operators.staging import staging, staging_from_readings, staging_from_text
from meterflow.schema import READING_SCHEMA
from meterflow.sources import archive, legacy, raw
from meterflow.sources.readings import as_json, readings, with_odometer
from meterflow.streaming.sources import check_messages

READING = (
    "event_id string, meter_id string, zone_id string, customer_type string, "
    "reading_ts timestamp_ntz, kwh_delta double, voltage double, power_factor double, "
    "power_kw double, frequency_hz double, meter_state string"
)


def ts(text):
    return dt.datetime.fromisoformat(text)


def make(spark, rows):
    """Readings from (id, meter, zone, time, kwh[, state])."""
    full = [
        (str(r[0]), r[1], r[2], "residential", ts(r[3]), r[4], 120.0, 0.9, r[4] * 12, 60.0,
         r[5] if len(r) > 5 else "normal")
        for r in rows
    ]
    return spark.createDataFrame(full, READING)


def test_round_half_up(spark):
    df = spark.sql("select explode(array(2.675D, 0.125D, -0.125D, 1.00499D)) x")
    got = [r[0] for r in df.select(round_half_up(F.col("x"), 2)).collect()]
    assert got == [2.68, 0.13, -0.13, 1.0]


def test_sum_kwh_is_exact(spark):
    df = spark.range(100_000).select(F.lit(0.0001).alias("x"))
    assert df.agg(sum_kwh(F.col("x"))).first()[0] == 10.0


def test_day_of_week(spark):
    df = spark.sql("""select explode(array(timestamp_ntz'2026-07-04 10:00:00',
        timestamp_ntz'2026-07-05 00:00:00', timestamp_ntz'2026-07-06 23:59:59')) reading_ts""")
    got = [r[0] for r in df.select(times.day_of_week(F.col("reading_ts"))).collect()]
    assert got == [6, 0, 1]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:34:56.789' t")
        t = times.whole_second(F.col("t"))
        row = df.select(
            times.floor_window(t, 300), times.hour_start(t), times.day_start(t),
            times.epoch_millis(t), times.as_wall_time(times.as_instant(t))).first()
        assert row[0] == ts("2024-03-10T02:30:00")
        assert row[1] == ts("2024-03-10T02:00:00")
        assert row[2] == ts("2024-03-10T00:00:00")
        assert row[3] == 1710038096000
        assert row[4] == ts("2024-03-10T02:34:56")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_window_size_has_to_divide_the_day():
    with pytest.raises(ValueError):
        times.check_window(420)


def test_event_hour_falls_back_to_zero(spark):
    df = spark.createDataFrame([("2025-04-22T09:14:30Z",), ("not-a-time",), (None,)], "t string")
    assert [r[0] for r in df.select(times.event_hour(F.col("t"))).collect()] == [9, 0, 0]


def test_unknown_zone_goes_to_partition_0(spark):
    df = spark.createDataFrame([("ZONE-CENTRAL",), ("ZONE-X",), (None,)], "z string")
    assert [r[0] for r in df.select(zone_partition(F.col("z"))).collect()] == [4, 0, 0]


def test_window_edges(spark):
    df = make(spark, [
        (1, "A", "ZONE-EAST", "2026-07-01T10:00:00", 1.0),
        (2, "B", "ZONE-EAST", "2026-07-01T10:04:59", 2.0),
        (3, "A", "ZONE-EAST", "2026-07-01T10:05:00", 4.0, "fault"),
    ])
    rows = windows.zone_window_agg(df, expected={"ZONE-EAST": 1}).orderBy("window_start_ts").collect()
    assert [(r.total_kwh, r.active_meter_count, r.silent_meter_count, r.fault_count) for r in rows] == [
        (3.0, 2, 0, 0), (4.0, 1, 0, 1)]
    assert rows[0].window_end_ts == ts("2026-07-01T10:05:00")


def test_peak_power_is_at_least_zero(spark):
    df = make(spark, [(1, "A", "ZONE-EAST", "2026-07-01T10:00:00", -1.0)])
    assert windows.zone_window_agg(df).first().peak_power_kw == 0.0


def test_demand_delta_skips_empty_slots_and_zero_totals(spark):
    df = make(spark, [
        (1, "A", "ZONE-EAST", "2026-07-01T10:00:00", 2.0),
        (2, "A", "ZONE-EAST", "2026-07-01T10:10:00", 3.0),
        (3, "A", "ZONE-EAST", "2026-07-01T10:15:00", 0.0),
        (4, "A", "ZONE-EAST", "2026-07-01T10:20:00", 5.0),
    ])
    rows = windows.with_demand_delta(windows.zone_window_agg(df)).orderBy("window_start_ts").collect()
    assert [r.demand_vs_prev_window_pct for r in rows] == [None, 50.0, -100.0, None]


def test_unnamed_zone_expects_100_meters(spark):
    df = make(spark, [(1, "A", "ZONE-X", "2026-07-01T10:00:00", 2.0)])
    assert windows.zone_window_agg(df, expected={"ZONE-EAST": 1}).first().silent_meter_count == 99


def test_split_meters_gives_the_remainder_to_the_first_zones(spark):
    row = spark.range(1).select(windows.split_meters(F.lit(12))).first()[0]
    assert [r.n for r in row] == [3, 3, 2, 2, 2]


def test_silent_outranks_faults(spark):
    df = spark.createDataFrame([(4, 1), (3, 1), (3, 0)], "silent_meter_count int, fault_count int")
    assert [r[0] for r in df.select(windows.status_label()).collect()] == [
        "SILENT METERS", "FAULTS", "OK"]


def test_grid_has_a_row_for_every_slot(spark):
    df = make(spark, [
        (1, "A", "ZONE-EAST", "2026-07-01T23:50:00", 2.0),
        (2, "A", "ZONE-WEST", "2026-07-02T00:05:00", 3.0),
    ])
    grid = windows.fill_window_grid(windows.zone_window_agg(df))
    assert grid.count() == 5 * 4
    assert grid.filter("is_empty").count() == 18
    assert grid.agg(F.sum("total_kwh")).first()[0] == 5.0


def test_staging_flags_are_false_for_unknown_state(spark):
    event = '{"meter_id": "A", "timestamp": "2026-07-05T10:07:07Z", "voltage": 100, "customer_type": "x"}'
    df = raw.with_src(spark.createDataFrame([(event,)], "value string")).withColumn(
        "load_ts", F.lit("2026-07-05").cast("timestamp_ntz"))
    row = staging(df).first()
    assert (row.is_fault, row.is_normal, row.is_low_power_factor) == (False, False, False)
    assert row.voltage_deviation_pct is None and row.kwh_delta is None
    assert (row.day_of_week_num, row.day_of_week_name, row.is_weekend) == (0, "Sun", True)
    assert row.window_bucket == ts("2026-07-05T10:05:00")


def test_strict_staging_raises_and_lenient_gives_null(spark):
    df = raw.with_src(spark.createDataFrame(
        [('{"kwh_delta": "much", "timestamp": "soon"}',)], "value string")).withColumn(
        "load_ts", F.lit("2026-07-05").cast("timestamp_ntz"))
    with pytest.raises(Exception):
        staging(df).collect()
    row = staging(df, strict=False).first()
    assert row.kwh_delta is None and row.reading_ts is None


def test_three_stagings_agree(spark, sf):
    r = with_odometer(readings(spark, sf))
    text = as_json(r, ["load_ts"])
    a, b = staging(raw.with_src(text)), staging_from_text(text)
    c = staging_from_readings(r).select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert a.exceptAll(c).isEmpty() and c.exceptAll(a).isEmpty()


GOOD = ('{"event_id":"e","meter_id":"M","zone_id":"ZONE-EAST","kwh_delta":1.0,"power_kw":1.0,'
        '"voltage":120.0,"power_factor":0.9,"frequency_hz":60.0,"meter_state":"normal",'
        '"timestamp":"2026-07-01T10:00:00Z"}')


@pytest.mark.parametrize("text, reason", [
    (GOOD, None),
    (GOOD[:30], "bad_json"),
    (None, "bad_json"),
    ("[1, 2]", "missing_keys"),
    # an event without power_kw, power_factor and frequency_hz
    ('{"event_id":"e","meter_id":"MTR-TEST","zone_id":"ZONE-EAST","customer_type":"residential",'
     '"timestamp":"2026-07-01T10:00:00Z","kwh_delta":0.025,"voltage":120.0,"meter_state":"normal"}',
     "missing_keys"),
    (GOOD.replace('"voltage":120.0', '"voltage":null'), "null_required"),
    (GOOD.replace('"voltage":120.0', '"voltage":"high"'), "bad_value"),
    (GOOD.replace("2026-07-01T10:00:00Z", "not-a-time"), "bad_timestamp"),
])
def test_quarantine_reasons(spark, text, reason):
    df = spark.createDataFrame([(text,)], "value string")
    got = [r.reason for r in raw.quarantine(df).collect()]
    assert got == ([reason] if reason else [])
    assert raw.usable(df).count() == (0 if reason else 1)


def test_fields_are_read_in_one_pass(spark):
    """The fields are those of a look-up of each alone, and the plan has one pass for all of them."""
    odd = [GOOD, GOOD[:30], None, "[1, 2]", "7", "null", "{}", GOOD.replace('"M"', "12.50"), GOOD.replace("120.0", '"120"'),
           GOOD.replace("120.0", "[1]"), GOOD.replace("60.0", "1e400"), GOOD.replace('"normal"', '{"a":[1,null]}'),
           GOOD.replace('"e"', "17"), GOOD.replace('"e"', "null"), GOOD.replace('"e"', '"17"'), GOOD.replace("voltage", "Voltage"),
           GOOD[:-1] + ',"signal_strength_dbm":99999999999,"is_anomaly":"true","other":{"voltage":1}}']
    messages = spark.createDataFrame([(t, None) for t in odd], "value string, offset long")
    names = [f.name for f in READING_SCHEMA.fields if f.name != "timestamp"]
    checked = check_messages(messages)
    alone = raw.with_src(messages).select("value", *[
        F.try_variant_get("src", f"$.{n}", READING_SCHEMA[n].dataType.simpleString()).alias(n) for n in names])
    assert sorted(map(repr, checked.select("value", *names).collect())) == sorted(map(repr, alone.collect()))
    few = check_messages(messages, ["voltage"])
    assert few.columns == ["value", "offset", "reason", "voltage", "reading_ts", "arrival_seq"]
    kept = few.columns
    assert sorted(map(repr, few.collect())) == sorted(map(repr, checked.select(kept).collect()))
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("try_variant_get(") == 1


def test_fill_defaults(spark):
    df = spark.createDataFrame(
        [(None,) * 6], "kwh_delta double, power_kw double, power_factor double, voltage double, "
        "frequency_hz double, meter_state string")
    assert tuple(raw.fill_defaults(df).first()) == (0.0, 0.0, 0.0, 0.0, 60.0, "normal")


def test_checks_let_null_pass_accepted_values(spark):
    rows = [("A", None, 1.0, "normal"), ("B", "ZONE-X", 0.0, "odd"), (None, "ZONE-EAST", -1.0, None)]
    df = spark.createDataFrame(rows, "meter_id string, zone_id string, kwh_delta double, meter_state string")
    got = {(r.check_name, r.column_name): r.failed_rows for r in quality.dq_report(df).collect()}
    assert got == {
        ("not_null", "meter_id"): 1, ("not_null", "zone_id"): 1, ("not_null", "kwh_delta"): 0,
        ("accepted_values", "zone_id"): 1, ("accepted_values", "meter_state"): 1,
        ("not_negative", "kwh_delta"): 1,
    }


def test_legacy_rows_become_readings(spark):
    rows = [("M-1", "ZONE-EAST", "commercial_3phase", "2026-05-01T06:30:00Z", 6.8, 230.0, 10.0, 0.95,
             50.1, "fault", False, "2026-05-01T06:30:05Z")]
    row = legacy.normalise_legacy(spark.createDataFrame(rows, legacy.LEGACY_SCHEMA)).first()
    assert (row.zone_id, row.customer_type, row.kwh_delta) == ("ZONE-EAST", "commercial", 6.8)
    assert (row.power_kw, row.event_type, row.kwh_reading) == (2.185, "alert", None)
    assert len(row.event_id) == 64


def test_push_payload_has_no_null_change(spark, sf):
    w = windows.zone_window_agg(
        readings(spark, sf).withColumn("a", F.lit(False)), expected=100, anomaly="a")
    rows = routing.to_push_rows(windows.with_demand_delta(w))
    assert rows.filter("demand_vs_prev_window_pct is null").isEmpty()
    payload = routing.push_payload(rows).first().payload
    assert payload.startswith('[{"zone_id":"ZONE-') and payload.endswith("}]")


def test_scenarios_wrap_over_midnight(spark):
    df = make(spark, [
        (1, "A", "ZONE-EAST", "2026-07-01T23:30:00", 1.0),
        (2, "A", "ZONE-EAST", "2026-07-02T00:29:59", 1.0),
        (3, "A", "ZONE-EAST", "2026-07-02T00:30:00", 1.0),
        (4, "A", "ZONE-WEST", "2026-07-02T00:10:00", 1.0),
    ])
    night = [{"name": "night", "hour": 23, "minutes": 90, "zones": ["ZONE-EAST"]}]
    assert {r.event_id for r in analysis.tag_scenarios(df, night).collect()} == {"1", "2"}


def test_totals_agree(spark, sf):
    from meterflow.operators import marts
    r = readings(spark, sf)
    stg = staging_from_readings(r)
    total = r.agg(sum_kwh(F.col("kwh_delta"))).first()[0]
    for df in (windows.zone_window_agg(r), marts.mart_demand_heatmap(stg),
               marts.mart_zone_daily(stg), marts.mart_customer_segment(stg)):
        assert df.agg(sum_kwh(F.col("total_kwh"))).first()[0] == total


def test_grid_and_outages_have_unknown_zones_and_silent_slots(spark):
    df = make(spark, [
        (1, "A", "ZONE-X", "2026-07-01T02:00:00", 5.0),
        (2, "B", "ZONE-EAST", "2026-07-01T02:05:00", 2.0),
        (3, "B", "ZONE-EAST", "2026-07-01T02:10:00", 0.0),
    ])
    agg = windows.zone_window_agg(df)
    grid = windows.fill_window_grid(agg)
    assert grid.agg(F.sum("total_kwh")).first()[0] == 7.0
    expected = spark.createDataFrame([("ZONE-X", 2), ("ZONE-EAST", 1)], "zone_id string, n long")
    out = windows.zone_outages(agg, 300, expected, zones=["ZONE-X", "ZONE-EAST"])
    assert {(r.zone_id, r.window_start_ts.minute, r.silent_meter_count) for r in out.collect()} == {
        ("ZONE-X", 5, 2), ("ZONE-X", 10, 2), ("ZONE-EAST", 0, 1)}


def test_completeness_lists_hours_without_readings(spark):
    df = staging_from_readings(make(spark, [
        (1, "A", "ZONE-EAST", "2026-07-01T01:10:00", 5.0),
        (2, "A", "ZONE-EAST", "2026-07-01T03:10:00", 2.0),
    ]))
    rows = quality.hour_completeness(df, {"ZONE-EAST": 2, "ZONE-WEST": 1}).collect()
    assert {(r.zone_id, r.reading_hour.hour, r.meters, r.complete_pct) for r in rows} == {
        ("ZONE-EAST", 1, 1, 50.0), ("ZONE-EAST", 2, 0, 0.0), ("ZONE-EAST", 3, 1, 50.0),
        ("ZONE-WEST", 1, 0, 0.0), ("ZONE-WEST", 2, 0, 0.0), ("ZONE-WEST", 3, 0, 0.0)}


def test_composition_counts_meters_of_other_types(spark):
    rows = [("Z", "A", "residential"), ("Z", "B", None), ("Z", "C", "kiosk"), ("Z", "A", "residential")]
    stg = spark.createDataFrame(rows, "zone_id string, meter_id string, customer_type string")
    row = dashboards.fleet_composition(stg).first()
    assert (row.residential, row.commercial, row.industrial, row.total) == (1, 0, 0, 3)


def test_missing_signal_is_unknown(spark):
    stg = spark.createDataFrame([("Z", None), ("Z", -60), ("Z", -95)], "zone_id string, signal_strength_dbm int")
    assert {r.signal_band for r in quality.signal_bands(stg).collect()} == {"unknown", "excellent", "very_poor"}


def test_load_stamp_is_utc_in_any_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamp = raw.with_load_ts(spark.range(1)).first().load_ts
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs(stamp - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_the_copy_loaded_first_stays(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 3, "only")]
    df = spark.createDataFrame(rows, "event_id string, load_ts int, note string").repartition(3)
    assert {r.note for r in raw.dedup(df).collect()} == {"early", "only"}
    assert raw.dedup(df).columns == df.columns


# --- calendar and sketches ---------------------------------------------------

def test_calendar_entries_overlap_and_run_over_midnight(spark):
    at = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    calendar = spark.createDataFrame([
        ("night", None, at(1, 23), at(2, 2)), ("a", "Z1", at(1, 23, 30), at(1, 23, 31)), ("a", "Z1", at(1, 23, 0), at(2, 0)),
        ("all", "ALL", at(2, 1), at(2, 1, 30)), ("never", "Z1", at(2, 1), at(2, 1)), ("open", "Z1", at(2, 1), None),
        (None, "Z1", at(1, 0), at(3, 0)), ("edge", "Z2", at(2, 0), at(2, 1))],
        "scenario string, zone_id string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    rows = spark.createDataFrame([
        (1, "Z1", at(1, 23, 30)), (2, "Z2", at(1, 23, 30)), (3, "Z2", at(2, 0)), (4, "Z2", at(2, 1)), (5, "Z1", at(2, 2)),
        (6, None, at(2, 1, 10)), (7, "Z1", None), (8, "Z1", at(1, 22, 59)), (8, "Z1", at(1, 22, 59))],
        "id int, zone_id string, reading_ts timestamp_ntz")
    tagged = analysis.with_calendar(rows, calendar)
    assert sorted((r.id, r.scenarios) for r in tagged.collect()) == [
        (1, ["a", "night"]), (2, ["night"]), (3, ["edge", "night"]), (4, ["all", "night"]), (5, []), (6, ["all", "night"]),
        (7, []), (8, []), (8, [])]
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_calendar_entries_of_a_name_become_stretches(spark):
    """600 entries in three hours: a list has a name once for each gap; names are those of a plain search."""
    at = lambda s: dt.datetime(2024, 1, 1, 22) + dt.timedelta(seconds=s)
    entries = [("busy", "Z1", at(i), at(i + 5000)) for i in range(0, 5000, 10)]
    entries += [("gaps", z, at(i), at(i + 300)) for z in ("Z1", "ALL", None) for i in range(0, 7200, 900)]
    entries += [("touch", "Z2", at(i), at(i + 100)) for i in range(0, 7600, 100)]
    calendar = spark.createDataFrame(
        entries, "scenario string, zone_id string, start_ts timestamp_ntz, end_ts timestamp_ntz").repartition(3)
    listed = {(r["scenario"], r["_zone"], r["_hour"]): r["n"] for r in analysis.calendar_stretches(calendar)
              .groupBy("scenario", "_zone", "_hour").agg(F.count("*").alias("n")).collect()}
    assert listed == {
        **{("busy", "Z1", at(h * 3600)): 1 for h in range(3)}, **{("touch", "Z2", at(h * 3600)): 1 for h in range(3)},
        **{("gaps", z, at(h * 3600)): 4 for z in ("Z1", None) for h in range(2)}}
    readings = [(i, z, at(i * 97 - 50)) for i in range(110) for z in ("Z1", "Z2", "ALL", None)]
    tagged = analysis.with_calendar(
        spark.createDataFrame(readings, "id int, zone_id string, reading_ts timestamp_ntz"), calendar)
    assert sorted((r.id, str(r.zone_id), r.scenarios) for r in tagged.collect()) == sorted(
        (i, str(z), sorted({n for n, of, a, b in entries if of in ("ALL", None, z) and a <= t < b})) for i, z, t in readings)


def test_sketches_merge_over_windows_and_zones(spark):
    """20,000 meters, each in several windows: the merged estimate is near the exact number."""
    df = spark.range(60_000).selectExpr(
        "concat('M', id % 20000) AS meter_id", "concat('Z', id % 2) AS zone_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id % 90000) AS reading_ts")
    nobody = spark.createDataFrame([(None, "Z9", dt.datetime(2024, 1, 1))], df.schema)
    kept = windows.meter_sketches(df.unionByName(nobody))
    whole = windows.merged_meters(kept).first().meters
    assert abs(whole - 20_000) < 4 * 1.04 / 64 * 20_000
    by_zone = {r.zone_id: r.meters for r in windows.merged_meters(kept, "zone_id").collect()}
    assert by_zone["Z9"] == 0 and all(abs(by_zone[z] - 10_000) < 650 for z in ("Z0", "Z1"))
    assert kept.filter("zone_id = 'Z9'").first().active_meter_count == 0


def test_archive_files_rotate(spark, tmp_path):
    """An hour of more rows than a file may hold is cut into several files; nothing is lost or in a wrong folder."""
    hour = "timestamp_ntz'2024-02-03 04:00:00'"
    rows = spark.range(1000).selectExpr(
        "id", f"{hour} + make_dt_interval(0, IF(id < 900, 0, 1), 0, id % 3600) AS reading_ts")
    path = str(tmp_path / "archive")
    archive.write_archive(rows, path, max_records_per_file=100)
    files = (spark.read.schema("id long, hour int").json(path)
             .groupBy("hour", F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.max("id").alias("last")))
    kept = {r.hour: (r.rows, r.largest, r.files, r.last) for r in files.groupBy("hour").agg(
        F.sum("n").alias("rows"), F.max("n").alias("largest"), F.count("*").alias("files"), F.max("last").alias("last")).collect()}
    assert kept[4][:2] == (900, 100) and kept[4][2] >= 9 and kept[4][3] == 899
    assert kept[5][0] == 100 and kept[5][1] <= 100 and kept[5][3] == 999
    archive.write_archive(rows.filter("id < 10"), path, max_records_per_file=100)  # later files are added, none replaced
    assert spark.read.schema("id long").json(path).count() == 1010
