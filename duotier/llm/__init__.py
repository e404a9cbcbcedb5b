"""Operators of a training-data pipeline (mixing, binary output, deduplication, scans, scoring, search, packing).

Nothing else in the library imports this package.  Its functions run on
workers that may not have the repository on their path, so they are pickled
by value."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
