"""Operators for preparing training corpora. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# functions that run in Spark's Python workers travel with the job: workers need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
