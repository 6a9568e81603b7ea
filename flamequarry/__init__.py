"""flamequarry: profiling analytics and corpus preparation on Spark.

Functions that run on executors are shipped by value: a cluster needs pyspark, numpy, pandas and pyarrow there, but no copy
of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
