"""Operators for large corpora of training text.

Nothing else in the library imports this package.  Its functions reach executors
inside the tasks, so that the workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
