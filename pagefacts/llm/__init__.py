"""Operators for training-data pipelines; nothing else in the library imports this package.

Each module holds one operator with its query. Functions that run in tasks are pickled by
value, so workers need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
