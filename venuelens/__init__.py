"""venuelens: venue listing and review analytics on Spark.

Every operator is a plain function ``DataFrame(s) -> DataFrame`` written with the
DataFrame API / Spark SQL / ``pyspark.ml``.  Sub-packages:

* ``functions``  column-level helpers (cleaning scalars, text scalars)
* ``sources``    readers for files, landing tables, payloads, stored pages
* ``operators``  cleaning, filters, aggregates, joins, windows, sets, text,
                 recommendation, competition, trends, rating model, sinks
* ``plans``      composed jobs: cleaning pipelines, reports, dashboard
* ``streaming``  Structured Streaming forms of the batch jobs
* ``registry``   the registered queries and their DuckDB oracle SQL
"""

__version__ = "0.1.0"
