"""corvina: a Spark-first engine for cleaning, canonicalising and analysing messy corpora."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code along: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
