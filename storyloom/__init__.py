"""storyloom: curate scraped documents into an event warehouse with Spark.

Every operator is a ``DataFrame -> DataFrame`` function. The helpers that run in
Python workers travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
