"""Streaming forms of the operators."""

from pyspark import cloudpickle

import shelfstream

# Stateful processors travel to the workers by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(shelfstream)
