"""Training-data operators: search, quality, sharding, deduplication, WARC,
tokenisation and decontamination as Spark jobs.

Nothing else in the library imports this subpackage. Functions that run inside
Python workers are shipped with the job (pickled by value), so executors need
not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
