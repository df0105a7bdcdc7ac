"""Column expressions built from ``pyspark.sql.functions`` (JVM-side)."""
