"""State-access analytics on Spark."""
