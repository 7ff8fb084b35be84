"""Operators of a training-data pipeline, each ``f(DataFrame, **params) -> DataFrame``.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers travel with the task, so workers need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
