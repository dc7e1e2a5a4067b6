"""Operators for training-data pipelines: tokenising, cleaning, de-duplication, extraction.

Each module holds one operator over a ``documents`` (or ``pages``) frame and
``queries`` registers one query per operator. Nothing outside this package
imports it.

Functions that Spark ships to Python workers are pickled by value, so that
executors need the libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
