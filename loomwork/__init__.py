"""Table and stream operators for panel, transaction, document and shop analytics on Spark."""

import sys

from pyspark import cloudpickle

# Helpers run inside tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
