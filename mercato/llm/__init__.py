"""Training-data operators (documents, benchmark, pages) and their queries.

Nothing else in the library imports this subpackage.  Its functions travel to
the executors by value, so a cluster needs no copy of it on their path."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
