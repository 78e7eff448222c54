"""Training-data operators: PII, similarity joins, LM scoring, formatting, packing and cleaning.

Task functions of this subpackage are pickled by value, so that executors need
no copy of the repository on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
