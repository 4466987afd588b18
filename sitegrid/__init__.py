"""Point-of-interest analytics as Spark DataFrame plans."""
