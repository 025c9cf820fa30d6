"""Operators of a training-data pipeline: filtering, deduplication, sharding, tokenising, packing and search.

Nothing outside this subpackage imports it. Each module holds one operator with its general interface; ``queries``
registers one query per operator on the test tables.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
