"""Operators for preparing text and vectors for language-model training. Nothing else in the library imports this.

Functions of this package travel to executors by value, so the cluster's machines need only numpy, pyarrow and regex.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
