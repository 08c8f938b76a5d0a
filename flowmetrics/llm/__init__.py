"""Training-data operators: each module is one operator with its own general
interface; ``queries`` registers the digest queries, ``oracles`` their SQL."""

import sys

from pyspark import cloudpickle

# Task functions travel with their tasks: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
