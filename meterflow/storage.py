"""Where intermediate tables go: a folder every executor can reach."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under `spark.checkpoint.dir`.

    The setting must name a shared folder on a cluster. Only a local session
    without it falls back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="meterflow-")
    return f"{base.rstrip('/')}/meterflow/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back, cutting its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
