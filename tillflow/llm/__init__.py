"""Operators for large text corpora, and their registered queries.

What tasks run in Python travels with them: executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
