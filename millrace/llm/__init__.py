"""Operators of a training-data pipeline.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so that those need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
