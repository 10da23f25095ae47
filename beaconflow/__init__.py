"""Signal-event analytics as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

# The few functions that run inside Python tasks travel with the job, so the
# executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
