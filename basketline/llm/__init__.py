"""Operators for training-data pipelines: filters, duplicates, tokens, mixing, fingerprints.

Functions of this package that run in Python workers are sent by value, so that a session started
without the package on its workers' path can run them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
