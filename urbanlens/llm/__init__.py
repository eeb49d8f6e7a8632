"""Operators for preparing training text, one module per operator.

Nothing outside this package imports it. Functions that run inside tasks are
pickled by value, so executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

from urbanlens import session

for _module in (sys.modules[__name__], session):
    cloudpickle.register_pickle_by_value(_module)
