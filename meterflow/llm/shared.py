"""Values sent once to every executor. Their size has to be bounded by whoever sends them."""

import pickle

from pyspark import cloudpickle
from pyspark.sql import SparkSession


class Shared:
    """A broadcast of any object; its classes need not be installed on the executors."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self, "_value"):
            self._value = pickle.loads(self._sent.value)
        return self._value

    def __getstate__(self):
        return {"_sent": self._sent}
