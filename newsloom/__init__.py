"""News collection as lazy PySpark DataFrame jobs."""
