"""Corpus operators: preparing training text at scale."""

import sys

from pyspark import cloudpickle

# Python code that runs in tasks travels with the tasks: workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
