"""Job-market analytics as Spark jobs: column-parameterised operators over postings, labels and history."""

import sys

from pyspark import cloudpickle

# Small Python functions travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
