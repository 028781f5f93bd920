"""Training-data operators (toxicity, tokens, decontamination, sharding, ...).

Nothing else in the package imports this subpackage; see ``queries.py`` for
the registered queries and the README for each operator's contract.
"""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
