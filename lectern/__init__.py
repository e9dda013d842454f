"""lectern: corpus-to-answer analytics expressed as Spark DataFrame plans.

Sub-packages:
  sources    scans of tables, JSON catalogues and landed text files
  functions  Column-expression builders (text cleaning, tokenising, vectors, n-grams)
  operators  DataFrame -> DataFrame operators (chunking, embedding, search, metrics, ...)
  plans      composite jobs and the registered queries with their SQL oracles
  streaming  Structured Streaming re-aims of the batch jobs
"""

import sys as _sys

# Python workers may not have this package on their path (driver-only checkouts,
# notebooks).  Functions from this package are pickled by value into the tasks.
from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from lectern.session import build_session, scratch_dir  # noqa: E402

__all__ = ["build_session", "scratch_dir"]
