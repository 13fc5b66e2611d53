"""docweave: document collections, metadata tables and vector tables on Spark.

Every operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); Spark plans, partitions and runs the work.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel inside the task, so executors need
# no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
