"""Scholarly-metadata and text-similarity engine on PySpark."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
