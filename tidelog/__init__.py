"""Event-log, relational and document analytics written with PySpark DataFrames."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions of this package travel to the executors as code, so only the driver needs it installed.
register_pickle_by_value(sys.modules[__name__])
