"""Customer tickets to routed, monitored topics, as Spark jobs."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
