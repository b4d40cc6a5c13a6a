"""Operators for preparing training text. Nothing else in the library imports this subpackage."""

from pyspark import cloudpickle

import tidegrid

# The functions that run in Python workers travel with their tasks.
cloudpickle.register_pickle_by_value(tidegrid)
