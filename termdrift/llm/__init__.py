"""Operators of a training-data pipeline; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions run by executors travel with their code, so that a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules["termdrift.llm"])
