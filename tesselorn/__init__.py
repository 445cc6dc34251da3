"""PySpark-native analytics over large corpora of small XML documents.

Functions that run on executors are pickled by value, so a worker needs no
copy of this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
