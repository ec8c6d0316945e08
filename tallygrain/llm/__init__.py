"""Operators for preparing training data.

Functions of this package are sent to Python workers whole, so executors need not have it
installed.
"""

import sys

from pyspark.cloudpickle import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
