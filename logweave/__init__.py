"""logweave: event-log analytics operators for PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark
SQL expressions, so it runs unchanged on batch tables and, where the
semantics allow, on Structured Streaming DataFrames.
"""

import sys

__version__ = "0.1.0"

# Functions that run in Python workers (``mapInPandas`` bodies and the
# helpers they call) are pickled by value, so executors need no installed
# copy of this package: the code travels with each task.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: ship the package instead
    pass
