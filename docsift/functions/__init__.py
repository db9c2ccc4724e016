"""Column functions: each takes and returns Spark Columns and stays in the JVM."""
