"""Operators of a training-data pipeline, and the queries that run them."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
