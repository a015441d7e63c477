"""Spark-native curation engine for labelled, multi-image house records."""

import sys

from pyspark import cloudpickle

# Python workers get the package's functions with their tasks: no executor needs it on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
