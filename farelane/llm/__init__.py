"""Operators of a training-data pipeline, one module per operator.

Nothing else in the package imports this subpackage.  Functions that run
inside Spark tasks are shipped by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
