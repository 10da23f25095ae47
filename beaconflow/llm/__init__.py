"""Operators for preparing training data of language models."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, as those of the parent package do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
