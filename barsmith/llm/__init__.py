"""Training-data operators: deduplication, archives, filters, classifiers, search, mixing.

Nothing else in the library imports this subpackage. Its functions travel to the executors
with the job (pickled by value), so the executors need no installed copy of it.
"""

import sys

from pyspark.cloudpickle import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
