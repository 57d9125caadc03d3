"""Patent first-filing analytics on Spark."""
