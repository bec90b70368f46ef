"""casewright: support-ticket cleaning, labelling, enrichment and scoring as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Code that runs in Python workers travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
