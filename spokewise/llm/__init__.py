"""Operators that prepare text and vectors for training a language model."""

import sys

from pyspark import cloudpickle

# Tasks get the functions themselves, so that workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
