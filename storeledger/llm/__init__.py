"""Operators for preparing training text at scale; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions for tasks travel whole, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
