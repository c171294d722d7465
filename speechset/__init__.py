"""Speech-corpus dataset building on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions shipped to Python workers are sent with their code, so executors need numpy, pandas
# and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
