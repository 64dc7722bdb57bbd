"""Operators for preparing large text corpora for language-model training.

Nothing else in the library imports this subpackage. Its functions are pickled
by value, so executors run them without having the package installed; inside
tasks they need only numpy and pyarrow.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
