"""Transport-network analytics as PySpark DataFrame jobs."""
