"""Usage, churn and what-if analytics for customer accounts on Spark.

Every public function takes DataFrames and plain parameters and returns a
DataFrame, so plans stay lazy and Catalyst sees the whole query.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

__version__ = "0.1.0"

# Functions that run in Python tasks travel with the task, so executors need
# pandas and numpy but not this package.
register_pickle_by_value(sys.modules[__name__])
