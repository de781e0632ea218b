"""Operators for preparing training text at scale; nothing else in the library imports this package.

Functions that run in tasks travel with their code, so that executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
