"""Operators for building language-model training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# What runs inside tasks travels with them, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
