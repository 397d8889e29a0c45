"""papyrine: a PySpark-native analytics engine for scholarly-collaboration data.

Functions sent to the executors are pickled by value, so a cluster needs no copy of this package on its machines.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
