"""Fleet-telemetry analytics written as Spark DataFrame, SQL and Structured Streaming code."""
