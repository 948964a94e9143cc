"""Training-data operators: filtering, extraction, sharding, deduplication, PII, licences, decontamination, tokens."""

import sys

from pyspark import cloudpickle

# tasks get this package's functions with the job, so executors need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
