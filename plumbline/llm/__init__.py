"""Operators for training-data pipelines. Nothing outside this folder imports them.

Functions of this package travel to the Python workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
