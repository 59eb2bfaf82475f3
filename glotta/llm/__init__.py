"""Operators for preparing language-model training data; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions defined here travel to the Python workers by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
