"""Operators for preparing training corpora; nothing else in the library imports them.

Functions that run inside tasks travel with the job, so executors need numpy, pandas and
the like but not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
