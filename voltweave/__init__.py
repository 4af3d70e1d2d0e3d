"""Feature engineering, statistics and regression on site-by-day readings, as Spark plans.

Sub-packages
    sources    reading, writing and staging tables
    functions  column expressions (calendar, arithmetic, text, geography)
    operators  DataFrame -> DataFrame verbs (joins, windows, aggregates, statistics, sampling)
    steps      learned transforms written as pyspark.ml stages
    models     model specifications, resampling, tuning and scoring
    plans      feature tables, named feature recipes and end-to-end workflows
"""

import sys

from pyspark import cloudpickle

from voltweave.session import build_session

# Functions used inside tasks travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session"]
