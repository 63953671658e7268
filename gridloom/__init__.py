"""Spark-native analytics for point, grid and record-reconciliation workloads."""

import sys

from pyspark import cloudpickle

# Functions for executors travel whole, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
