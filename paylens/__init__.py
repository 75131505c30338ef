"""Run-scoped payment-risk analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few task-side helpers travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
