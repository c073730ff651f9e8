"""Spark-native pipeline from raw question/answer data to a fine-tuning dataset."""

import sys

from pyspark import cloudpickle

# Python functions travel to executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
