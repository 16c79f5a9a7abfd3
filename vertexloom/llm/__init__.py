"""Operators for large training corpora: mixing, scoring, scanning, deduplication, extraction, search."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks that call them, so
# that executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
