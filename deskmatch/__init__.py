"""Editor matching and submission analytics as Spark DataFrame jobs."""
