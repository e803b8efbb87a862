"""Strandline: a Spark-native engine for gridded time series and the vector products derived from them."""

import sys

from pyspark import cloudpickle

# Executors get the library's functions by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
