"""Operators for a training-data pipeline over ``documents``, ``embeddings``,
``pages``, ``benchmark`` and ``labels``.  Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# functions of this package travel with their tasks: executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
