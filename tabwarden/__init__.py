"""Spark jobs for labelled tables: clean, check, split, impute, train, score."""

import sys

from pyspark import cloudpickle

from tabwarden.spec import PHISHING, TableSpec

# The few functions that run in Python workers travel with the job, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["PHISHING", "TableSpec"]
