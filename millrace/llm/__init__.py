"""Operators for large text corpora: mixing, archives, filters, near-copies, token files and shards."""

import sys

from pyspark import cloudpickle

# tasks get these modules by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
