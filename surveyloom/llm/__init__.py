"""Operators that prepare training text: scans, searches, archives, copies, tokens, mixes and shards."""

import sys

from pyspark import cloudpickle

# what tasks run travels with the plan, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
