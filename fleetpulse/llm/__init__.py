"""Operators for preparing language-model training data.

Operators over the tables ``documents``, ``pages``, ``embeddings``,
``benchmark`` and ``labels``; nothing else in the library imports this package.  Each operator
module has a general DataFrame-in, DataFrame-out interface; ``queries`` holds
the thin ``op<N>_<name>`` queries with their fixed result columns.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a cluster
# needs no copy of the package on its Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
