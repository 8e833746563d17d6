"""Spark-native preparation, sampling, batching, scoring and evaluation of language data."""

import sys

from pyspark import cloudpickle

# Worker functions travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
