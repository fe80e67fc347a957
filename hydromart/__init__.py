"""hydromart: daily environmental observations -> analytical tables and next-day scores, on Spark.

Every public operator is a plain ``DataFrame -> DataFrame`` function (or returns a small
dict of DataFrames). Nothing is collected to the driver; rejects and data-quality
violations are DataFrames too.

Layout
------
functions/   column expressions (codes, dates, hashes, distances)
sources/     typed readers, column whitelists, landed JSON explode
operators/   versioned raw tables, upserts, thresholds, series windows, geo, quality, ML
plans/       staging views and marts composed from the operators, plus the query catalog
streaming/   Structured Streaming wrappers of the batch operators
"""

from hydromart.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
__version__ = "0.1.0"
