"""Operators of a training-data pipeline; nothing else in the library imports this subpackage.

Functions of this subpackage that run on executors are shipped by value, so a cluster
needs pyspark, numpy, pyarrow and xxhash there but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
