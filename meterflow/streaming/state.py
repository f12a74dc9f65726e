"""What a stream knows from one micro-batch to the next, as tables in a shared folder.

A micro-batch reads what the batches before it left and writes its own part under its
number. A batch that runs again after a failure finds the same tables and replaces its
part, so nothing counts twice.
"""

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Kept:
    """Rows by key. Each batch adds those that it changed, every tenth writes all of them.

    So a batch reads one whole table and nine changes at most. `live` is a condition that
    rows have to meet to be carried into a whole table.
    """

    def __init__(self, path: str, schema: str, keys: Sequence[str], every: int = 10, live: str | None = None):
        self.path, self.keys, self.every, self.live = path, list(keys), every, live
        self.schema = T.StructType.fromDDL(schema)

    def seed(self, spark: SparkSession, rows: DataFrame | None = None) -> None:
        """What the first batch finds; nothing without `rows`."""
        found = spark.createDataFrame([], self.schema) if rows is None else rows.select(*self.schema.names)
        found.write.mode("overwrite").parquet(f"{self.path}/whole/n=-1")

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The latest row of each key that the batches before `batch_id` left."""
        last = batch_id - 1
        base = last - last % self.every if last >= 0 else -1
        whole = self._read(spark, "whole", [base])
        if last <= base:
            return whole.drop("n")
        return self._latest(whole.unionByName(self._read(spark, "changes", range(base + 1, last + 1))))

    def put(self, changed: DataFrame, batch_id: int) -> None:
        """Rows that replace those with their key."""
        changed = changed.select(*self.schema.names)
        if batch_id % self.every:
            changed.write.mode("overwrite").parquet(f"{self.path}/changes/n={batch_id}")
            return
        known = self.before(changed.sparkSession, batch_id).withColumn("n", F.lit(batch_id - 1).cast("long"))
        every = self._latest(known.unionByName(changed.withColumn("n", F.lit(batch_id).cast("long"))))
        if self.live is not None:
            every = every.filter(self.live)
        every.write.mode("overwrite").parquet(f"{self.path}/whole/n={batch_id}")

    def _latest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in self.schema.names if c not in self.keys]
        newest = F.max_by(F.struct(*values), "n").alias("_v")
        return rows.groupBy(*self.keys).agg(newest).select(*self.keys, "_v.*").select(*self.schema.names)

    def _read(self, spark: SparkSession, kind: str, numbers: Sequence[int]) -> DataFrame:
        logged = T.StructType([*self.schema.fields, T.StructField("n", T.LongType())])
        root = f"{self.path}/{kind}"
        return spark.read.schema(logged).option("basePath", root).parquet(*[f"{root}/n={n}" for n in numbers])


class DayLog:
    """Rows in a folder for each micro-batch and day, and an index of the folders of a day.

    Readers open the folders of the days they ask for and no others, and of these the files
    that have the hours. A day with many folders is merged into one: the merged rows
    are written first, then the index names them instead. The folders merged stay, so a
    reader with an older index is right too, and `path` itself is the whole log at any time.
    """

    def __init__(self, path: str, schema: str, ts: str, merge_from: int = 16):
        self.path, self.ts, self.merge_from = path, ts, merge_from
        self.schema = T.StructType.fromDDL(schema)
        self.index = Kept(f"{path}-index", "day string, folder string, live boolean", ["day", "folder"], live="live")

    def seed(self, spark: SparkSession) -> None:
        self.index.seed(spark)

    def write(self, rows: DataFrame, batch_id: int, root: str = "") -> DataFrame:
        """Log the rows of a batch; returns them as logged."""
        dealt = rows.select(*self.schema.names, _day(self.ts).alias("_day")).hint("rebalance", "_day")
        dealt.write.mode("overwrite").partitionBy("_day").parquet(f"{self.path}{root}/batch_id={batch_id}")
        return self.of_batch(rows.sparkSession, batch_id)

    def of_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def publish(self, spark: SparkSession, batch_id: int, merge: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Add the folders of a logged batch to the index, and merge the days that have many with `merge`."""
        days = [r.day for r in self.of_batch(spark, batch_id).select(_day(self.ts).alias("day")).distinct().collect()]
        changes = [(day, self._folder("", batch_id, day), True) for day in days]
        if merge is not None:
            now = self.folders(spark, batch_id)
            if days:
                now = now.unionByName(spark.createDataFrame([c[:2] for c in changes], "day string, folder string"))
            crowded = now.groupBy("day").agg(F.collect_list("folder").alias("folders")).filter(
                F.size("folders") >= self.merge_from).collect()  # a few days, of `merge_from` folders or so
            if crowded:
                gone = [(r.day, f, False) for r in crowded for f in r.folders]
                rows = spark.read.schema(self.schema).parquet(*[f for _, f, _ in gone])
                self.write(merge(rows), batch_id, "-merged")
                whole = [(r.day, self._folder("-merged", batch_id, r.day), True) for r in crowded]
                changes = [c for c in changes if (*c[:2], False) not in gone] + gone + whole
        self.index.put(spark.createDataFrame(changes, self.index.schema), batch_id)

    def folders(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """(day, folder) as the batches before `batch_id` left them."""
        return self.index.before(spark, batch_id).filter("live").drop("live")

    def read(self, spark: SparkSession, batch_id: int, hours: DataFrame) -> DataFrame:
        """The rows between the first and the last of some hours (`hour`) and on their days, as the
        batches before `batch_id` logged them."""
        span = hours.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"), F.collect_set(_day("hour")).alias("days")).first()
        return self._between(spark, batch_id, span.lo, span.hi, F.col("day").isin(span.days))

    def read_between(self, spark: SparkSession, batch_id: int, lo: datetime | None, hi: datetime | None) -> DataFrame:
        """The rows of the hours from `lo` to `hi`, as the batches before `batch_id` logged them."""
        ends = (F.date_format(F.lit(x).cast("timestamp_ntz"), _DAY) for x in (lo, hi))
        return self._between(spark, batch_id, lo, hi, F.col("day").between(*ends))

    def _between(self, spark: SparkSession, batch_id: int, lo: datetime | None, hi: datetime | None, days: Column) -> DataFrame:
        names = [] if lo is None else self.folders(spark, batch_id).filter(days).collect()
        if not names:
            return spark.createDataFrame([], self.schema)
        first, last = (F.date_trunc("hour", F.lit(x).cast("timestamp_ntz")).cast("timestamp_ntz") for x in (lo, hi))
        log = spark.read.schema(self.schema).parquet(*[r.folder for r in names])
        return log.filter((F.col(self.ts) >= first) & (F.col(self.ts) < last + F.expr("INTERVAL 1 HOUR")))

    def _folder(self, root: str, batch_id: int, day: str) -> str:
        return f"{self.path}{root}/batch_id={batch_id}/_day={day}"


#: A day as text that no reader takes for a number.
_DAY = "'d'yyyyMMdd"


def _day(ts: str) -> Column:
    return F.date_format(ts, _DAY)
