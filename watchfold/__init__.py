"""watchfold: pay-TV watch and search logs turned into monthly facts, views and checks on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's own
relational operators; only :mod:`watchfold.sources` and
:mod:`watchfold.plans.warehouse` touch storage.
"""

__all__ = ["functions", "operators", "plans", "sources"]

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry the package's code with them, so a
# cluster needs no copy of it on its machines and a job may start in any folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
