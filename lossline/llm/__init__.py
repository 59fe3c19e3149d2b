"""Operators for preparing training data; nothing else in the library imports them.

Each module holds one operator with its own interface; ``queries`` registers the
thin ``opN_<name>`` queries over the given tables.
"""

import sys

from pyspark import cloudpickle

# tasks carry this package's functions themselves: executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
