"""meterflow: smart-meter event analytics as Spark DataFrame, SQL and streaming operators."""
