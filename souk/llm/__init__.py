"""Operators of a training-data pipeline over documents, vectors and chats."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with their code, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
