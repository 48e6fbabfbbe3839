"""Training-data operators: language ID, toxicity, near-duplicate joins, fingerprints,
secret scans, tokenisation, chat formatting, sharding and packing.

Nothing else in the library imports this package. Functions that run inside
Spark tasks are pickled by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
