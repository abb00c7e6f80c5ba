"""Case, telecom, market, weather and tower analytics as Spark DataFrame jobs."""
