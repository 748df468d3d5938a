"""Operators for preparing training text: language, dedup, privacy, tokens, chat.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when the package is present.

Functions of this package that run in Python workers travel by value, so a
cluster needs no copy of the package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
