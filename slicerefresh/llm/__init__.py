"""Operators for training-data pipelines over ``documents`` and ``pages``.

Each module holds one operator; ``queries`` registers them.  Nothing outside
this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the tasks, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
