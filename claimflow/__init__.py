"""claimflow: a Spark-native claims, policy and retention analytics engine.

Every operator is a pure ``DataFrame -> DataFrame`` function that takes an
explicit ``as_of`` clock. Catalyst plans the joins, aggregations and windows;
Python runs only inside Arrow-batched scorers (``mapInPandas``) where no
built-in expression exists.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers by value, so that a job needs the package on
# the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
