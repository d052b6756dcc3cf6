"""Daily weather against hospital admissions, as Spark DataFrame jobs."""
