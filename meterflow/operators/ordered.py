"""Order-dependent work per key that does not put a whole key into one task.

A window over a meter would collect all of its readings, however many, in one
task. Here a key is cut into slots (an hour, a stretch of arrivals); the slots
are windowed side by side and only their small summaries are ordered per key.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FOLD = {"sum": F.sum, "max": F.max}


def running_by_slot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slot: Column,
    value: str, out: str, how: str = "sum",
) -> DataFrame:
    """Add `out`, the running sum or maximum of `value` per key in `order`.

    `slot` must not decrease along `order`. The value carried into a slot is
    the fold of the totals of the slots before it.
    """
    fold = _FOLD[how]
    # structs are equal where their NULL fields are, so a row with a NULL key finds its own total
    placed = df.withColumn("_at", F.struct(*keys, slot.alias("_slot")))
    inside = Window.partitionBy("_at").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(F.struct(*[F.col(f"_at.{k}") for k in keys])).orderBy("_at._slot").rowsBetween(
        Window.unboundedPreceding, -1)
    # totals are added up before they are shuffled, from no more columns than they need
    totals = placed.groupBy("_at").agg(fold(value).alias("_total"))
    carried = totals.select("_at", fold("_total").over(before).alias("_carried"))
    if how == "sum":
        total = F.coalesce(F.col("_carried"), F.lit(0)) + F.col("_within")
    else:
        total = F.greatest("_carried", "_within")
    return (
        placed.withColumn("_within", fold(value).over(inside)).join(carried, "_at", "left")
        .withColumn(out, total).drop("_at", "_within", "_carried")
    )


def with_halo(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slot: Column,
    cols: Sequence[str], rows: int,
) -> tuple[DataFrame, Window]:
    """`keys`, `order` and `cols` of `df` plus, per slot, copies of the last `rows` rows before it.

    Returns the frame and a window spec over its slots. A function looking back
    at most `rows` rows is right on every row that is not `_halo`; filter those
    copies out with `without_halo` afterwards.
    """
    kept = list(dict.fromkeys([*order, *cols]))
    slotted = df.select(*keys, *[c for c in kept if c not in keys], slot.alias("_slot"))
    packed = F.struct(*[c for c in kept if c not in keys])
    from_end = Window.partitionBy(*keys, "_slot").orderBy(*[F.desc(c) for c in order])
    tails = (
        slotted.withColumn("_rank", F.row_number().over(from_end))
        .filter(F.col("_rank") <= rows)
        .groupBy(*keys, "_slot")
        .agg(F.sort_array(F.collect_list(packed)).alias("_tail"))
    )
    # every slot has a row, so the last `rows` rows lie in the last `rows` slots
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(-rows, -1)
    gathered = F.flatten(F.collect_list("_tail").over(earlier))
    start = F.greatest(F.size("_all") - rows + 1, F.lit(1))
    halo = (
        tails.withColumn("_all", gathered)
        .select(*keys, "_slot", F.explode(F.slice("_all", start, F.lit(rows))).alias("_row"))
        .select(*keys, "_slot", "_row.*", F.lit(True).alias("_halo"))
    )
    both = slotted.withColumn("_halo", F.lit(False)).unionByName(halo)
    return both, Window.partitionBy(*keys, "_slot").orderBy(*order)


def without_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("_halo")).drop("_halo", "_slot")
