"""Operators for building training corpora out of document tables.

Python functions of this subpackage travel to the executors by value, so that
these do not need the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
