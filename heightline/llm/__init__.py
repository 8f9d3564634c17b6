"""Training-data operators: near and exact copies, mixing, packing, scores and chat formatting."""

import sys

from pyspark import cloudpickle

# Worker functions of this package travel with the job; executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
