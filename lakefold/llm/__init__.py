"""Operators of a training-data pipeline over `documents` and `pages`.

Functions that run in tasks travel by value, so Python workers need not have
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
