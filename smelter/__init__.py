"""Bronze, silver and gold warehouse layers as Spark DataFrame functions."""
