"""millrace: warehouse ingestion, relational operators, analytics jobs, streams and ML on PySpark."""

import sys

from pyspark import cloudpickle

# tasks carry the code of the package, so it need not be installed on the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
