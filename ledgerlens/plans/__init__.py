"""Runnable plans: the batch ETL job, the registered query catalog, oracle SQL and SQL report text."""
