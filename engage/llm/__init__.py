"""Operators that prepare text corpora for language-model training, and their registered queries.

Functions of this package that run in tasks travel with the tasks, so that executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
