"""Operators for training-data pipelines: text, vectors, archives and mixtures.

Nothing else in the library imports this subpackage. Its functions travel to
executors by value, so a cluster needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
