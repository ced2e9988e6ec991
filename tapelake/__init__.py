"""Crypto market-data lake on Spark: landing, typed tables, top of book, upkeep."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so that no executor needs
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
