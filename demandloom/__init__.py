"""Weekly retail demand on Spark: store clusters, product propensity, forecasts and plans."""

import sys

from pyspark import cloudpickle

# Task functions travel with their job, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
