"""Operators of a training-data pipeline over whole document tables.

Every module holds one operator: a general function over a DataFrame and
column names, written as Spark jobs with NumPy only inside tasks. The thin
``opN_*`` queries live in :mod:`tidewater.llm.queries`.

Functions that run on executors are pickled by value, so a session needs
neither this package installed on its executors nor ``--py-files``.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
