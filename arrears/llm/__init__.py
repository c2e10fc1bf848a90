"""Training-data operators: one module each, with the named queries in ``queries``.

Functions that run inside Python workers are shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
