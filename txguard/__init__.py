"""Payment-fraud analytics as plain Spark DataFrame, SQL, streaming and MLlib jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run on executors travel with their jobs, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
