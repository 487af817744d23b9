"""Operators for training-data pipelines; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage run inside tasks: ship their code with them, so
# executors need numpy, pandas and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
