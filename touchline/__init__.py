"""Event and tracking analytics, and corpus preparation, written as Spark DataFrame jobs."""
