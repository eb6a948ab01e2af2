"""mailposture: e-mail authentication analytics as Spark jobs.

Functions that run in Python workers travel with the job (pickled by value), so that executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
