"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers one query per operator and
``corpus_sql`` holds the DuckDB SQL of those that SQL can express. Nothing
else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers whole, so that
# executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
