"""Models on distributed rows."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so the executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
