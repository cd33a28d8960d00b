"""Operators for training-data pipelines: tokens, quality, duplicates, personal data, secrets, language models, mixing.

Nothing outside this package (and `corpus_pipeline.py`, which belongs to it) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so the executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
