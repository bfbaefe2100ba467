"""Column-in, Column-out building blocks; everything stays in JVM expressions."""
