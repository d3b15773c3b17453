"""Operators for training data at scale; nothing else in the library imports them.

Task functions of this package travel to the executors by value, so the executors need no
copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
