"""Operators for training-data pipelines: filtering, deduplication, packing, search and audits of text corpora."""

import sys

from pyspark import cloudpickle

# Functions run in tasks travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
