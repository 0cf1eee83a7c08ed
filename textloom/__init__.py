"""Text-classification data work on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python workers receive these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
