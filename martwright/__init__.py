"""martwright: domain marts, metrics and data checks as PySpark DataFrame transforms.

Every transform takes DataFrames and returns a lazy DataFrame, so Catalyst sees one plan from
the parquet scan to the result. Sub-packages:

* ``sources``   typed scans, published tables, report and failing-row sinks, the date spine
* ``functions`` Column -> Column helpers (surrogate key, safe division, bucketing, date parts)
* ``plans``     the models: staging, commercial, finance, marketing, product, analytics
* ``operators`` metrics, checks, contracts, freshness, profiling and catalog health
* ``registry``  every query by name, next to the SQL it is checked against
"""
