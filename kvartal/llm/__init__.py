"""Operators for building language-model training data, and their queries.

Each module holds one operator. Functions sent to executors travel with their code, so
the package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
