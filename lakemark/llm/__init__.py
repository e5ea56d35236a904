"""Operators for large text collections, and the queries that apply them.

Nothing outside this folder, ``tests/llm`` and the guard in ``__spark_entry__.py``
knows this package.
"""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
