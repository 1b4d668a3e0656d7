"""tessera: single-cell spatial analytics expressed as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Executors need no copy of the package: what they run is sent with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
