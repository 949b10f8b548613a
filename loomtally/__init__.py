"""Spark DataFrame operators for term ranking, question scoring and clustering,
survey summaries and ordered keyed concatenation.

Functions and classes that run inside tasks travel with them, so executors need no copy of
the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
