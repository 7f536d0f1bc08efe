"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors need not have the package: its functions travel with the jobs that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
