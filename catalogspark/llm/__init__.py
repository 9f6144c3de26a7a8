"""Operators for training-data pipelines. Python workers get these modules' functions by value with each job, so
executors need no copy of the package; vocabulary files are read from the executor's own installation."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
