"""Reliability analytics for interruption records, built on DataFrames, Spark SQL and Spark ML."""

import sys

from pyspark import cloudpickle

# The few functions that run in tasks travel with them, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
