"""recordloom: Spark-native hybrid records, profiling, vector search and entity mapping.

Every public function takes DataFrames (or a SparkSession plus a path) and
returns lazy DataFrames, so callers compose them like built-in transformations.
"""

import sys

from pyspark import cloudpickle

# Functions run inside tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
