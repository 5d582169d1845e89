"""Training-data operators over ``documents``, ``pages``, ``labels`` and ``benchmark``.

Nothing else in the library imports this subpackage.  Task functions are
pickled by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
