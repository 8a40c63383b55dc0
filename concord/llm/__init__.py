"""Training-data operators; nothing else in the library imports this subpackage.

The functions that run on executors are pickled by value, so executors need
only the third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
