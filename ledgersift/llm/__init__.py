"""Operators for preparing training text: deduplication, filtering, decontamination and mixing.

Python functions of this package travel to the executors by value, so a job needs no copy of the
package there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
