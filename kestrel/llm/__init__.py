"""Operators of a large-scale training-data pipeline.  Nothing else in the library imports this package.

Functions that run inside Spark's Python workers are shipped by value, so executors need
numpy, pyarrow and the named tokenizer/hash libraries, but not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
