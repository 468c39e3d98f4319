"""Operators for preparing training data: packing, selection, deduplication, search, mixing, privacy.

Nothing outside this package imports it.  ``queries.py`` holds the registered
queries and ``oracle.py`` their DuckDB SQL.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
