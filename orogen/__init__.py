"""orogen: terrain, observation and event analytics as Spark DataFrame operators."""
