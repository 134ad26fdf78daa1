"""Operators for preparing training data at scale.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when the folder is there.  Functions that run inside tasks
are sent by value, so the executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
