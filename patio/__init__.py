"""patio: listings analytics as PySpark DataFrame operators."""
