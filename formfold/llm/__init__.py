"""Operators for preparing training data, and the registered queries over them.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds its
queries when it is present.
"""

import sys

from pyspark import cloudpickle

# Functions travel to executors by value, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
