"""Edit-stream processing and analytics as plain Spark DataFrame transformations."""
