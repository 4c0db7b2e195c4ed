"""eventide: event-stream and table operators written as PySpark DataFrame functions.

Every operator takes and returns a DataFrame, so the same function serves a
batch DataFrame and (where the operator is stateless or uses Spark's own
streaming state) a streaming one.
"""

__version__ = "0.1.0"

# Functions and processor classes of this package that run in Python workers
# (mapInPandas folds, stateful processors) are shipped by value, so executors
# need no installed copy of the package.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
