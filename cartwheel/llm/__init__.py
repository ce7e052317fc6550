"""Operators for preparing training text: language, secrets, packing, near
duplicates, URL filters, archive records, decontamination, tool calls, exact
duplicates and page extraction.  Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# executors need no copy of this package: its functions travel with the tasks
cloudpickle.register_pickle_by_value(sys.modules[__name__])
