"""Spark-native engine for price-tag observations and training-data operators."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions that run in Python workers
# travel by value with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
