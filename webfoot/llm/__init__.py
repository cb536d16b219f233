"""Operators for large training-data pipelines (documents, pages, vectors)."""

import sys

from pyspark import cloudpickle

# The per-batch helpers travel with the tasks, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
