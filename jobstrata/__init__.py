"""jobstrata: a PySpark-native engine for job-posting history.

Every operator is a function from DataFrames to DataFrames.  Nothing is
collected to the driver, order is always carried in explicit columns, the
clock is injected and the network stays outside (fetch results arrive as a
table).
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python workers may run where the package isn't installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
