"""Bronze, silver and gold tables as plain PySpark DataFrames and streams."""

import sys

from pyspark import cloudpickle

# The few functions that run in tasks travel with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
