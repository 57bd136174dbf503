"""Event analytics on PySpark: tables, streams, windows, patterns."""

import sys

from pyspark import cloudpickle

# User functions travel to the Python workers by value, so the package needs to
# be installed only where the driver runs.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
