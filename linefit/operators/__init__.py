"""Operators on DataFrames: summaries, splits, feature stages, models, tuning, metrics."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with them, so executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
