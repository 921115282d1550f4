"""Operators of a training-data pipeline: one module per operator, their queries in ``queries``.

Functions of this package travel to the executors by value, so that a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
