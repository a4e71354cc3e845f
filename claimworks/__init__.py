"""Healthcare claims analytics as Spark DataFrame, SQL, MLlib and streaming jobs."""
