"""Operators for preparing large text corpora; nothing else in the package imports this."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so that this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
