"""Sensor-telemetry analytics on Spark: decode, screen, train, score, detect and fan out readings."""

import sys

from pyspark import cloudpickle

# Functions and data sources reach the executors with the task, so that they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
