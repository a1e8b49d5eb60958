"""Health-insurance claims analytics and fraud detection on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with their code, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
