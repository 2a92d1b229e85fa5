"""tablewright: DataFrame operators and ML stages for table preparation, profiling,
featurization, scoring and evaluation on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
