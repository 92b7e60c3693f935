"""Attribute extraction over large image and text collections, on Spark.

Functions and classes of this package reach Python workers by value, so executors
need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
