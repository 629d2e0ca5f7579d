"""Operators for training-data pipelines over text. Nothing else in the package imports these."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to executors whole, so that no executor has to import them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
