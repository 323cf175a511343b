"""Operators for preparing training text: sharding, packing, near-duplicates, filters, token files, search."""

import sys

from pyspark import cloudpickle

# Tasks get this code with the job, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
