"""Operators of a training-data pipeline. Nothing outside this folder imports it.

Functions that run in tasks travel with the job, so executors need not have
this package installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
