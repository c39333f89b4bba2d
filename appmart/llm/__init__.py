"""Operators of a training-data pipeline, each over whole tables of Spark rows.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Its
functions travel to the executors with the tasks, so executors need no copy
of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
