"""Training-data operators: quality, mixing, near-duplicates, packing, LM scoring,
language ID, line rules, secret scans, document fingerprints, repeated passages.

Nothing else in the library imports this subpackage. Its task-side functions
are shipped with the job (by value), so executors need numpy, pandas, pyarrow,
xxhash and the tokenizer libraries, but not this package, on their path.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
