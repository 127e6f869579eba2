"""pulsegrid: time-series quality control, catalogue and cohort analytics as Spark DataFrame jobs."""
