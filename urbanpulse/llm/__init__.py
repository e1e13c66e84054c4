"""Training-data pipeline operators: recognition, deduplication, decontamination,
scoring and mixing of text documents.

Each module holds one operator with a general interface; ``queries`` holds the
thin registered queries that apply them to whole tables.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: a cluster needs
# no copy of the repository on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
