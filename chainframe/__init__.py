"""Chain-history analytics as plain Spark DataFrame operators."""
