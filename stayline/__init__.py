"""Customer-attrition analytics as Spark DataFrame jobs."""
