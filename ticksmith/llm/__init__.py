"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing else in the library imports this package.  Its functions are pickled
by value, so Spark's Python workers need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
