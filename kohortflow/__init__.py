"""Register-cohort analytics on Spark DataFrames.

Sub-packages: ``sources`` (scans and sinks), ``streaming`` (incremental ingest), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (analysis tables and whole studies),
``checks`` (the operators applied to the given test tables, next to equivalent SQL).
"""
