"""frameml: statistics and learning on Spark DataFrames.

Rows stay in DataFrames from scan to result.  Only model-sized state (a d x d
matrix, k centres, tree nodes, layer weights) ever reaches the driver.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside Python workers travel with the job, so executors
# need numpy and pyarrow but no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
