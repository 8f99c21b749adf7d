"""Pick-up hotspots and driver suggestions on Spark."""
