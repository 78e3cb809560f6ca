"""Order-lifecycle analytics as plain Spark DataFrame plans."""
