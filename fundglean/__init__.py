"""Set-based analytics over long regulatory filings, written for Spark.

Sub-packages: ``sources`` (readers and table sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps) and ``plans`` (the
jobs that compose them).
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the plan, so the executors
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
