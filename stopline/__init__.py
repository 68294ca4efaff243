"""stopline: Spark jobs that turn transit prediction pages into audited lateness labels.

The package is organised by role: ``sources`` (pages, tables, derived inputs),
``functions`` (column expressions), ``operators`` (DataFrame to DataFrame steps),
``plans`` (whole jobs), ``streaming`` (Structured Streaming jobs) and ``catalog``
(named queries with their check SQL).
"""
