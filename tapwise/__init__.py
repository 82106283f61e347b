"""Payment-card transaction analytics on PySpark."""
