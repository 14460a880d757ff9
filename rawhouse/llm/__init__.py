"""Corpus operators for preparing training data: language identification,
near-duplicate detection, benchmark decontamination, personal data, licences,
page text, toxicity, tokenisation and sharding.

Each operator is a ``DataFrame -> DataFrame`` function with its own columns as
parameters.  ``queries`` holds the registered queries over the driver's tables
and ``oracle`` their DuckDB SQL where SQL can express them.
"""

import sys

from pyspark import cloudpickle

# Functions of this package run in Python workers; shipping them by value means
# executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
