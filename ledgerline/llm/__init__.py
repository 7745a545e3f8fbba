"""Training-data operators: near-duplicates, language, quality, mixing,
fingerprints, tokens, packing, archives, licences, exact code search, hard
negatives and dataset manifests.

Nothing else in the library imports this subpackage.  Task-side functions are
pickled by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
