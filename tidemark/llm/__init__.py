"""Operators of a training-data pipeline over ``documents``-like tables.

One module per operator; ``queries.py`` registers the thin ``opN_<name>``
queries and their SQL.  Nothing outside this package imports it.

The functions that run on executors are shipped by value, so executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
