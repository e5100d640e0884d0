"""navloom: fund and portfolio analytics written as plain Spark DataFrame functions."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
