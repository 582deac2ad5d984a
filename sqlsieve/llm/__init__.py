"""Operators and queries for building training data out of documents, pages and conversations.

Nothing else in the library imports this package. Functions that run in Python workers are
pickled with their modules' code, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
