"""Spark-native preparation, checking and scoring of chat training data."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Python tasks carry the functions they run, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
