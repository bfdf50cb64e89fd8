"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing else in the library imports this subpackage.  ``registry`` lists the
queries and their SQL; ``__spark_entry__.py`` adds them when the subpackage
can be imported.

Functions that run inside tasks travel by value, so executors need the listed
third-party libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
