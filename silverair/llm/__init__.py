"""Operators of a training-data pipeline: labels, chat rendering, duplicates, leaks, URL lists and token ids.

Operators take frames and return frames. Work on whole texts that SQL functions
cannot express runs in Arrow batches of bounded size; Spark deals out the rows.
"""

import sys

from pyspark import cloudpickle

# Executors may not have this package installed, so its code travels with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
