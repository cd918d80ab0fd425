"""Operators of a training-data pipeline over `documents`, `pages` and `embeddings`."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers whole, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
