"""dispersa: counting and point-set geometry on Spark DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python tasks (the Arrow kernels) must not need this package installed on the
# executors: ship its functions by value with each task instead of by import path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
