"""Product-catalog search and change-feed processing as Spark DataFrame jobs."""
