"""Operators of a training-data pipeline over documents, conversations and embeddings.

Functions that run in Python tasks are shipped by value, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
