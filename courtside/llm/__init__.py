"""Corpus operators for large text collections (nothing else in the library imports them).

Functions of this package that run in Python workers travel by value, so a
cluster needs no copy of the package on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
