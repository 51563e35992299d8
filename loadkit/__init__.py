"""loadkit: repair, validate, cast, classify and load messy CSV and NDJSON with Spark."""

import sys

from pyspark import cloudpickle

from loadkit.session import configure

# Functions that run on executors travel with their task, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure"]
