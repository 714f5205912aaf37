"""Operators for preparing language-model training data, as Spark jobs.

Nothing else in the library imports this subpackage.  Functions that run in
Spark's Python workers are pickled by value, so the workers need only numpy
and pyarrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
