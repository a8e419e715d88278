"""Training-data operators: filtering, deduplication, mixing, packing, scoring.

One module per operator, ``shared`` and ``text`` for what several of them
need, ``queries`` for the registered ``opN_*`` queries and their oracles.
Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy
# of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
