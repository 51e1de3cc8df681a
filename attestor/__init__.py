"""Spark-native triple/evidence evaluation engine."""

import sys

from pyspark import cloudpickle

# Executors get this package's functions with the job and need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
