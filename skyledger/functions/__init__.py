"""Column functions; all compile to JVM expressions."""
