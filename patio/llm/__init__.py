"""Training-data operators: tokenising, mixing, classifying, filtering and deduplicating text.

Functions of this package that run in Python workers are pickled by value, so that executors need
no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
