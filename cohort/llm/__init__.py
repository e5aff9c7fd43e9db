"""Operators for preparing training text: duplicates, quality, mixing, packing.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  Functions
that run inside Python workers are sent by value, so a cluster needs the
libraries they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
