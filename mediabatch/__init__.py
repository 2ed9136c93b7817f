"""Batch media pipelines over creator/URL tables as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run inside Python tasks travel with the plan: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
