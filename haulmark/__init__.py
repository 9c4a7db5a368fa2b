"""Equipment telemetry and maintenance analytics as lazy Spark DataFrame operators."""
