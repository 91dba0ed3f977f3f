"""Operators for preparing training data: text, pages, vectors and their selection. Nothing else imports this."""

import sys

from pyspark import cloudpickle

# tasks get the functions of this package with their code, so executors need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])
