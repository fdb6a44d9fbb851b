"""Market time series and news analytics as Spark DataFrame jobs."""
