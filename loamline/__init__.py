"""Loamline: parcel-risk analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their code, so a cluster needs no copy of this package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
