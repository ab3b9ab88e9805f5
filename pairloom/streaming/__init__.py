"""Metrics and best steps of runs, watched while they arrive."""

import sys

from pyspark import cloudpickle

# the state processor travels to the executors with its code: the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
