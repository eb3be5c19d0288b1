"""Operators for preparing training data, and their registered queries.

Nothing outside this package imports it.  Functions that run on executors are
pickled by value, so executors need only the public libraries, not this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
