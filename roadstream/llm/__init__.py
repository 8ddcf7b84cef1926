"""Operators on text, vectors and web pages for preparing training data.

The package pickles its functions by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
