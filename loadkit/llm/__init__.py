"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their task, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
