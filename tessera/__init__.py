"""Tessera: a PySpark-native engine for single-cell and spatial count data."""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

# Functions of this package that run in Python workers travel by value, so the
# executors need no copy of the package on their own path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
