"""Operators for building training data: one module each, queries in ``queries``.

Task functions are shipped by value, so executors need Spark, NumPy and the
named libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
