"""Operators of a training-data pipeline over documents, benchmark, labels and embeddings.

Tasks get the functions of this package with the job, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
