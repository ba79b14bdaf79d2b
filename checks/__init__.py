"""Queries over the driver's tables, each with the SQL that must give the same rows where SQL can say it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
