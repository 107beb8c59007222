"""Column-level building blocks; everything here stays in JVM expressions."""
