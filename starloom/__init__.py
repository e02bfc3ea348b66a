"""starloom: star-schema sales warehouse operators on Spark DataFrames.

Sub-packages:

* ``functions``  column expressions (date parts, buckets, recoding, labels,
  HTML text, money)
* ``operators``  DataFrame operators (surrogate keys, dimensions, category
  bridge, lookups, facts, integrity checks)
* ``sources``    readers (JDBC / Parquet query sources, renaming, literal
  rows) and the fixture views over the test tables
* ``plans``      whole jobs (flagship star load, publish) and the query
  catalogue used by ``__spark_entry__``
* ``streaming``  intentionally empty: the modelled job is a full batch reload
"""

__version__ = "0.1.0"
