"""Commercial sales analytics as plain Spark DataFrame operators."""
