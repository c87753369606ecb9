"""Operators of a training-data pipeline over text and vectors. Nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# task functions travel with the job, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
