"""Data quality, drift and model life cycle over period-partitioned tables, as Spark jobs."""
