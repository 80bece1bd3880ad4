"""Panel audience pipeline expressed as PySpark DataFrame jobs."""
