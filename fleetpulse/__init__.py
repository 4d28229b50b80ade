"""fleetpulse: fleet condition-monitoring analytics on Spark DataFrames.

Sub-packages:

* ``sources``   – raw sensor matrices, Parquet tables, stand-in fleets.
* ``functions`` – column expressions (row means, rounding, labels, clocks).
* ``operators`` – ETL transforms, joins, analytics, marts, quality checks.
* ``plans``     – the named query catalogue and its DuckDB oracle SQL.

Every operator takes DataFrames plus parameters and returns a DataFrame; no
operator here runs a job while a query is built; loading (``operators.sink``)
and staged reading of raw text do, and say so.
"""

__version__ = "0.1.0"
