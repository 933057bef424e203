"""Analytics over stores of short text memories, expressed as Spark plans."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
