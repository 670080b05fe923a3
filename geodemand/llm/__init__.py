"""Training-data operators over text tables.

Ten operators (one module each) and the queries that apply them to the
driver tables (:mod:`geodemand.llm.queries`). Nothing else in the library
imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
