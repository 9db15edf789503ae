"""tickforge: market-data analytics (ingest, indicators, rollups, reports,
schema tooling) written as plain PySpark DataFrame -> DataFrame operators."""

import sys as _sys

__version__ = "0.1.0"

# Python workers (pandas UDFs, stateful processors) receive this package's
# functions and classes by value, so executors need no installed copy of it.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # older cloudpickle: workers then import the package
    pass
