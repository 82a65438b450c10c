"""Waste and demand analytics on a sales / preparation / waste star schema, as Spark jobs."""

import sys

from pyspark import cloudpickle

# the few Python steps are sent to the tasks by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
