"""Training-data operators: deduplication, quality, packing, formatting, mixing, scans.

Nothing outside this subpackage imports it; ``llm.registry`` holds its queries.
"""

import sys

from pyspark import cloudpickle

# Tasks get these functions with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
