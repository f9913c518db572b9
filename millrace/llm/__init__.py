"""Operators for preparing training text.

Functions that Spark ships to Python workers are pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
