"""vecspark: vector search and vector-table analytics as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Kernels run inside executor tasks; shipping them by value spares the cluster an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
