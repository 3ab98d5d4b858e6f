"""Operators for preparing training data.

Functions that run on the workers travel by value, so the workers need neither
this package nor the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
