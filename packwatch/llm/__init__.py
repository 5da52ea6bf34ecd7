"""Operators of a training-data pipeline: one module per operator, queries in ``queries.py``."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
