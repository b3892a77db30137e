"""Analytics operators, incremental ingest and raw-to-mart jobs as plain PySpark."""
