"""strataq: a PySpark-native engine for document structure and its data quality.

DataFrame in, DataFrame out.  ``operators`` holds the relational operators,
``functions`` the column expressions they share, ``sources`` readers and
writers, ``plans`` the registered queries and ``streaming`` the incremental
variants.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
