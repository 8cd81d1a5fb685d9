"""Posts analytics on Spark: extraction, entity resolution, rankings and period comparisons as DataFrame plans.

The functions that run inside tasks are shipped by value, so executors need no installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
