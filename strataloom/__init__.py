"""Spark-native curation, splitting, auditing and benchmarking of structured scientific data."""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
