"""Operators for training-data pipelines. Nothing else in the package imports this.

Functions that run in tasks travel by value, so executors need no copy of the package.
"""

from pyspark import cloudpickle

import corpusmill

cloudpickle.register_pickle_by_value(corpusmill)
