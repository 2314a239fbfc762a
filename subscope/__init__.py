"""Customer-intelligence operators for subscription businesses, as Spark DataFrame functions."""
