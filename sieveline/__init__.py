"""Literature-screening analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Kernels used inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
