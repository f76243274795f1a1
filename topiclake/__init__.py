"""topiclake: land JSON message topics in a data lake with Spark, and audit the landing."""
