"""Topic trees for web articles, built as Spark jobs.

Every public function takes and returns DataFrames or Columns and keeps no
hidden state; see README.md for the tour.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run in Python workers travel with the job, so the package need
# not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
