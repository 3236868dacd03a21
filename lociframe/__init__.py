"""Genome-wide association analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from lociframe.session import build_session, shared_path

# Python workers get the package's functions with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "shared_path"]
