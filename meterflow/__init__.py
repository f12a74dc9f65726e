"""Smart-meter analytics on Spark: ingest, staging, marts, windows and streams."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the executors with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
