"""Public-spending analytics as PySpark DataFrame jobs."""
