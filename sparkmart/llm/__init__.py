"""Operators for preparing language-model training data. Nothing else in the library imports this package.

What runs in tasks is sent along with them, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
