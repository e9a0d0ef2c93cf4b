"""Operators of a training-data pipeline; nothing else in the package needs them.

Functions that run in Python workers are sent to them with the job, so executors
need the libraries they use but no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
