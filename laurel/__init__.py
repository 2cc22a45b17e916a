"""Evidence mining over short posts, as Spark DataFrame jobs."""
