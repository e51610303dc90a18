"""paneflow: load JSON message streams into tables with PySpark."""

import sys

from pyspark import cloudpickle

# Tasks get the package's functions with the job, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
