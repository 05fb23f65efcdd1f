"""Operators of a pipeline that prepares text for training, and their queries."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so that executors need no copy
# of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
