"""catalink: record linkage and data consolidation on Spark DataFrames.

Subpackages: ``sources`` (readers and schemas), ``functions`` (column
functions and vectorised similarities), ``operators`` (relational operators),
``plans`` (the registered queries and their SQL), ``streaming`` (micro-batch
linkage).
"""

import sys

from pyspark import cloudpickle

# functions sent to the workers carry their code: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
