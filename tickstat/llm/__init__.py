"""Operators of a training-data pipeline over a ``documents`` table.

Nothing else in the library imports this package. Code that runs on Python
workers is pickled by value, so a worker needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
