"""Operators for preparing training text: URL filters, source mixing, quality
rules, licence scans, near-duplicate joins, exact substring removal, language
identification, benchmark decontamination, toxicity and secret scans."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with the code of this package, so that
# executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
