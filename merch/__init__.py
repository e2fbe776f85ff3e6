"""merch: merchandise analytics as PySpark DataFrame operations."""
