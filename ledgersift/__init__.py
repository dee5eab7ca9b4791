"""Suspicious-transaction analytics as plain DataFrame -> DataFrame functions."""

import sys

from pyspark import cloudpickle

from ledgersift.schema import TXN
from ledgersift.session import get_session

# Functions that run in Python workers travel by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["TXN", "get_session"]
