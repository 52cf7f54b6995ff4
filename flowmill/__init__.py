"""Flow-record analytics as Spark DataFrame, ML and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Ship the functions that run inside Arrow tasks by value, so that a cluster needs no
# copy of this package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
