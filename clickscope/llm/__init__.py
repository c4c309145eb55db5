"""Corpus operators for training-data pipelines.

One module per operator; ``queries`` binds them to the tables of a folder.
Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
