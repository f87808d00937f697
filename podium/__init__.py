"""Series scoring and standings on Spark."""
