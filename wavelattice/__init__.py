"""Waveform analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value: a worker started elsewhere cannot import it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
