"""Document analytics, retrieval and corpus preparation on PySpark."""
