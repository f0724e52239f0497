"""Spark operators for job-posting data: ingest, match, normalise, classify,
keep lifecycle state, search, report and stream."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Task functions travel to the executors with their code, so that the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
