"""Spark jobs that score payment transactions and analyse the decisions."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the job, so executors need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
