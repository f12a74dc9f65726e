"""Anomaly detection per meter: hourly moving average, and flat rolling mean."""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.numbers import kwh_units
from meterflow.functions.times import hour_start
from meterflow.operators.ordered import with_halo, without_halo
from meterflow.schema import EMA_ALPHA, EMA_THRESHOLD
from meterflow.storage import materialise

KEY = ["meter_id", "ema_hour"]
#: Readings of one meter and hour of day that a task runs through; more are cut into stretches.
STRETCH = 200_000


def ema_run(
    values: Sequence[float], baseline: float | None = None,
    alpha: float = EMA_ALPHA, threshold: float = EMA_THRESHOLD,
) -> tuple[list[bool], list[float | None]]:
    """Readings of one key in order: (flagged?, baseline after it) of each.

    The first reading sets the baseline. A flagged reading leaves it alone, and
    so does a missing one.
    """
    flags, after = [], []
    keep = 1 - alpha
    for x in values:
        flagged = False
        if x != x:
            pass
        elif baseline is None:
            baseline = x
        elif 0 < baseline * threshold < x:
            flagged = True
        else:
            baseline = alpha * x + keep * baseline
        flags.append(flagged)
        after.append(baseline)
    return flags, after


def ema_anomaly(
    df: DataFrame, alpha: float = EMA_ALPHA, threshold: float = EMA_THRESHOLD,
    carry_in: DataFrame | None = None, order: Sequence[str] = ("reading_ts", "event_id"),
    stretch: int = STRETCH,
) -> DataFrame:
    """Add `is_anomaly_ema` and `ema_baseline` (the baseline after the reading).

    A baseline is kept per meter and hour of day, some 22,000 readings a year.
    Rows reach their task sorted and are run through in batches, so no key is
    ever held in Python. A key of more than `stretch` readings is cut into
    stretches that run side by side (`_fold_stretches`). Long histories can also
    run load by load, each from the baselines of the one before (`carry_in`:
    meter_id, ema_hour, ema_baseline; `ema_baselines` makes them).
    """
    keyed = df.withColumn("ema_hour", F.hour("reading_ts"))
    starts = None
    if carry_in is not None:
        starts = carry_in.select(*KEY, F.col("ema_baseline").alias("start"))
    sizes = keyed.groupBy(*KEY).agg(F.count("*").alias("_size"))
    hot = sizes.filter(F.col("_size") > stretch)
    if hot.isEmpty():
        return _fold(keyed, KEY, starts, order, alpha, threshold).drop("ema_hour")
    # structs are equal where their NULL fields are
    hot = materialise(hot, "hot").select(F.struct(*KEY).alias("_key"))
    part = lambda rows, how: None if rows is None else (
        rows.withColumn("_key", F.struct(*KEY)).join(hot, "_key", how).drop("_key"))
    usual = _fold(part(keyed, "left_anti"), KEY, part(starts, "left_anti"), order, alpha, threshold)
    long = _fold_stretches(
        part(keyed, "left_semi"), KEY, part(starts, "left_semi"), order, alpha, threshold, stretch)
    return usual.unionByName(long).drop("ema_hour")


def ema_baselines(flagged: DataFrame, order: Sequence[str] = ("reading_ts", "event_id")) -> DataFrame:
    """The last baseline per meter and hour, which `carry_in` takes."""
    latest = F.max(F.struct(*order, "ema_baseline"))
    return (
        flagged.groupBy("meter_id", F.hour("reading_ts").alias("ema_hour")).agg(latest.alias("_l"))
        .select(*KEY, F.col("_l.ema_baseline").alias("ema_baseline"))
    )


def baseline_for_hour(baselines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Baselines of the `wanted` meters and hours, 0.0 where none was seen."""
    found = wanted.join(baselines, KEY, "left")
    return found.withColumn("ema_baseline", F.coalesce("ema_baseline", F.lit(0.0)))


def rolling_anomaly(
    df: DataFrame, n: int = 12, threshold: float = 3.0,
    order: Sequence[str] = ("reading_ts", "event_id"),
) -> DataFrame:
    """Flag readings above `threshold` times the mean of the meter's `n` readings before."""
    rows, w = with_halo(
        df.withColumn("_units", kwh_units(F.col("kwh_delta"))), ["meter_id"], order,
        hour_start(F.col("reading_ts")), ["event_id", "kwh_delta", "_units"], n,
    )
    before = w.rowsBetween(-n, -1)
    # compares whole units: x > threshold * total / n
    total, count = F.sum("_units").over(before), F.count("_units").over(before)
    summed = rows.withColumns({"_total": total, "history": count})
    over = F.col("_units") * F.col("history") > F.lit(threshold) * F.col("_total")
    flag = F.coalesce((F.col("_total") != 0) & over, F.lit(False))
    return (
        without_halo(summed.withColumn("is_anomaly_rolling", flag))
        .select("event_id", "meter_id", "reading_ts", "kwh_delta", "history", "is_anomaly_rolling")
    )


def _fold(
    rows: DataFrame, keys: Sequence[str], starts: DataFrame | None, order: Sequence[str],
    alpha: float, threshold: float,
) -> DataFrame:
    """Run the average over every key, from its row in `starts` if it has one.

    A start travels as an extra row sorted to the head of its key.
    """
    fed = _with_starts(rows, keys, starts)
    # the window sorts the rows of each key together, which is the order the average runs in
    in_key = Window.partitionBy(*keys).orderBy(F.col("_start").isNull(), *order)
    value = F.coalesce("_start", "kwh_delta")
    marked = fed.withColumn("_fresh", F.row_number().over(in_key) == 1)
    ran = marked.withColumn("_ema", _running_average(alpha, threshold)(value, F.col("_fresh")))
    return ran.filter(F.col("_start").isNull()).select(
        *rows.columns, F.col("_ema.flag").alias("is_anomaly_ema"),
        F.col("_ema.baseline").alias("ema_baseline"))


def _with_starts(rows: DataFrame, keys: Sequence[str], starts: DataFrame | None) -> DataFrame:
    """`rows` with `_start`, which is NULL but in a further row for each key with a start."""
    fed = rows.withColumn("_start", F.lit(None).cast("double"))
    if starts is None:
        return fed
    blank = [F.lit(None).cast(f.dataType).alias(f.name)
             for f in rows.schema.fields if f.name not in keys]
    heads = starts.filter(F.col("start").isNotNull())
    return fed.unionByName(heads.select(*keys, *blank, F.col("start").alias("_start")))


def _fold_stretches(
    rows: DataFrame, keys: Sequence[str], starts: DataFrame | None, order: Sequence[str],
    alpha: float, threshold: float, stretch: int,
) -> DataFrame:
    """As `_fold`, with each key in stretches that run side by side.

    Rows are sorted over all tasks, so a task has a stretch of consecutive rows, and only the
    baseline in which a stretch begins is not known in it. All stretches run from a
    guess; then those that did not begin in what the one before ended in run again from that, until
    all fit, bit for bit, so the result is that of one long run. An average forgets where it
    began within some 200 readings, so two rounds are usual. A stretch that is
    flagged throughout hands on what it was given and costs no round of its own.
    The driver holds a row for each stretch.
    """
    fed = _with_starts(rows, keys, starts).withColumn("_value", F.coalesce("_start", "kwh_delta"))
    sort = [*keys, F.col("_start").isNull(), *order]
    tasks = -(-rows.count() // stretch)
    placed = materialise(
        fed.repartitionByRange(tasks, *sort).withColumn("_part", F.spark_partition_id()), "stretches")
    parts = lambda frame: frame.repartition(tasks, "_part").sortWithinPartitions("_part", *sort)
    thin = placed.select("_part", *keys, "_start", *[c for c in order if c not in keys], "_value")
    ends: dict[int, dict] = {}
    begins: dict[int, float] = {}
    wanted = None
    while wanted is None or wanted:
        some = thin if wanted is None else thin.filter(F.col("_part").isin(wanted))
        ran = parts(some).mapInArrow(
            _stretch_ends(keys, begins, alpha, threshold),
            "part long, first string, last string, baseline double, passed boolean")
        ends.update({r.part: r.asDict() for r in ran.collect()})
        then = _begins(ends)
        wanted = [p for p in ends if not _same(then.get(p), begins.get(p))]
        begins = then
    out = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields)
    flagged = parts(placed).mapInArrow(
        _stretch_flags(keys, begins, alpha, threshold), f"is_anomaly_ema boolean, ema_baseline double{out}")
    return flagged.filter(F.col("_start").isNull()).select(*rows.columns, "is_anomaly_ema", "ema_baseline")


def _same(a: float | None, b: float | None) -> bool:
    return a == b or (a is not None and b is not None and a != a and b != b)


def _begins(ends: dict[int, dict]) -> dict[int, float]:
    """What each stretch that goes on with a key has to begin in, by what the ones before ended in."""
    begins, last, baseline = {}, None, None
    for part in sorted(ends):
        end = ends[part]
        if end["first"] == last and baseline is not None:
            begins[part] = baseline
        if not (end["passed"] and end["first"] == last):
            baseline = end["baseline"]
        last = end["last"]
    return begins


def _runs(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[int, str, int, int]]:
    """Runs of rows of one stretch and key: its number, the key as text, begin and end."""
    named = [batch.column("_part").to_pylist(), *[batch.column(k).to_pylist() for k in keys]]
    each = list(zip(*named))
    begin = 0
    for at in range(1, len(each) + 1):
        if at == len(each) or each[at] != each[begin]:
            yield each[begin][0], repr(each[begin][1:]), begin, at
            begin = at


def _stretch_ends(keys: Sequence[str], begins: dict[int, float], alpha: float, threshold: float):
    """Of each stretch: its first and last key, the baseline it ends in, and whether it is one key
    whose readings all leave the baseline alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        for batch in batches:
            values = batch.column("_value").to_pylist()
            for part, key, begin, end in _runs(batch, keys):
                if not found or found[-1]["part"] != part:
                    found.append({"part": part, "first": key, "last": key, "baseline": begins.get(part),
                                  "passed": True})
                now = found[-1]
                if now["last"] != key:
                    now.update(last=key, baseline=None, passed=False)
                before = now["baseline"]
                flags, after = ema_run(_floats(values[begin:end]), before, alpha, threshold)
                changed = before is None or not all(f or x is None for f, x in zip(flags, values[begin:end]))
                now.update(baseline=after[-1], passed=now["passed"] and not changed)
        yield pa.RecordBatch.from_pylist(found, schema=pa.schema([
            ("part", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("baseline", pa.float64()),
            ("passed", pa.bool_())]))

    return run


def _stretch_flags(keys: Sequence[str], begins: dict[int, float], alpha: float, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, baseline = None, None
        for batch in batches:
            values, flags, after = batch.column("_value").to_pylist(), [], []
            for part, key, begin, end in _runs(batch, keys):
                if at != (part, key):
                    baseline = begins.get(part) if at is None or at[0] != part else None
                    at = (part, key)
                some_flags, some_after = ema_run(_floats(values[begin:end]), baseline, alpha, threshold)
                flags += some_flags
                after += some_after
                baseline = some_after[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(flags, pa.bool_()), pa.array(after, pa.float64()), *batch.columns],
                names=["is_anomaly_ema", "ema_baseline", *batch.schema.names])

    return run


def _floats(values: list) -> list[float]:
    return [float("nan") if x is None else x for x in values]


def _running_average(alpha: float, threshold: float):
    """The average over sorted rows; only the value and the start-of-key mark go to Python.

    It carries the baseline from batch to batch, so it is marked as not
    deterministic: no filter may be moved below it.
    """
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        baseline = None
        for values, fresh in batches:
            values, firsts = values.tolist(), np.flatnonzero(fresh.to_numpy()).tolist()
            cuts = sorted({0, *firsts, len(values)})
            flags, after = [], []
            for begin, end in zip(cuts, cuts[1:]):
                if firsts and begin >= firsts[0]:
                    baseline = None
                some_flags, some_after = ema_run(values[begin:end], baseline, alpha, threshold)
                flags += some_flags
                after += some_after
                baseline = some_after[-1]
            yield pd.DataFrame({"flag": flags, "baseline": pd.Series(after, dtype=float)})

    return F.pandas_udf(run, "flag boolean, baseline double").asNondeterministic()
