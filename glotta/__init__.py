"""Multilingual document analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing runs until an
action is called, except the ``fit_*`` / ``train_*`` functions, which are eager
in the same way MLlib's ``fit`` is.
"""

import sys

from pyspark import cloudpickle

SEED = 53

# Functions defined here travel to the Python workers by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
