"""Operators of a pipeline that prepares text for training language models."""

import sys

from pyspark import cloudpickle

# Functions for tasks travel with the task, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
