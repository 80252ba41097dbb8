"""Spark-native analysis and forecasting of load series, many series at a time."""

import sys

from pyspark import cloudpickle

from gridtide.session import build_session

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
