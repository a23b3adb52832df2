"""Operators for large training-data corpora. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Tasks get the package's functions by value, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
