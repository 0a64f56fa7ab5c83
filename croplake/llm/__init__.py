"""Training-data operators over documents and web pages. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# tasks get the operators' functions with their plan, so that executors needn't have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
