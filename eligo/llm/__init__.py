"""Training-data operators: ten corpus operators, each on Spark frames.

Nothing outside this subpackage imports it; ``queries.py`` holds the thin
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job: executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
