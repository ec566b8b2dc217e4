"""Operators for preparing training text.  Nothing outside this subpackage imports it.

Functions that run on executors travel with the job (pickled by value), so
executors need numpy, pyarrow and the like but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
