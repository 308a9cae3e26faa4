"""Operators of a training-data pipeline: near-duplicate removal, decontamination, quality rules,
chat formatting, repeated-passage removal, toxicity, quality classification, source mixing,
language-model scoring and licence lookup.

Each module holds one operator with a general interface; ``queries`` applies them to the given
tables. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
