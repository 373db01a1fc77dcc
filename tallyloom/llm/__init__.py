"""Operators that prepare the training data of language models.

Nothing else in the library imports this package. Functions that run in Python
workers travel with the task; executors need numpy, pyarrow, xxhash, zstandard and
tokenizers, and not this package.

All operators share these rules. A null text counts as empty, a null id as an id
smaller than every other. Rows that share an id stay rows of their own: where rows
are joined back, the id goes together with a hash of the text, so rows equal in both
get equal results. Input columns that an operator does not name are ignored, or kept
as they are where it returns its input's columns.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
