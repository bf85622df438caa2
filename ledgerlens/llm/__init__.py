"""Operators for preparing training text, one module each.

Nothing else in the library imports this subpackage; its queries are in
``queries.py`` and are registered by ``__spark_entry__.py`` when present.

Functions that run in tasks are sent by value, so executors need no copy of
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
