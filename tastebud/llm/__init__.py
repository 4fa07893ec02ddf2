"""Training-data operators: the corpus side of the library.

Every operator takes DataFrames and returns DataFrames.  Kernels that run in Python
workers are numpy over Arrow batches and are shipped by value, so executors need numpy,
pandas and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
