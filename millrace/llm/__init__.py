"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# tasks carry the code of this subpackage, so it need not be installed on the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
