"""Sharded stream-log processing on Spark."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: functions go to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
