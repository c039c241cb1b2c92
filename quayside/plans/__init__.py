"""Plans: the load job, the workflow, the spark-submit entry and the query catalogue."""
