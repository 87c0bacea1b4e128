"""strata: software-repository analytics as plain Spark DataFrame jobs."""
