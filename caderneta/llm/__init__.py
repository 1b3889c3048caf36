"""Operators for preparing training text; nothing outside this folder imports it."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in tasks travel with the task, so executors need no copy of this code.
register_pickle_by_value(sys.modules[__name__])
