"""Training-data operators: scoring, deduplication, sharding, mixing, search and tokenization.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so executors
# need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
