"""corpusmill: corpus preparation (crawl, extract, chunk, prompt, split) on Spark DataFrames."""

import sys as _sys

__version__ = "0.1.0"

# Functions this package runs inside Python workers (mapInPandas) are pickled
# with their code, so executors need no installed copy of the package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship with --py-files
    pass
