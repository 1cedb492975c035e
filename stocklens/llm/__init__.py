"""Operations of a training-data pipeline on Spark: one module for each operator.

``registry`` lists the queries. Nothing outside this subpackage imports it. Functions that run on
executors are pickled by value, so workers need neither this package nor a certain folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
