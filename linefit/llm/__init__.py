"""Operators for training-data pipelines. Nothing else in the library imports this package.

Functions that run in tasks travel with the task (pickled by value), so executors need numpy,
pyarrow and the tokenizers library, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
