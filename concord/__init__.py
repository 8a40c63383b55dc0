"""Spark-first record linkage and data-quality engine."""

import sys

from pyspark import cloudpickle

# functions that run on executors are pickled by value, so executors need only the third-party libraries
cloudpickle.register_pickle_by_value(sys.modules[__name__])
