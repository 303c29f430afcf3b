"""Posting analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Ship this package's pandas UDFs by value, so that executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
