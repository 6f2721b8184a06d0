"""Column expressions. All stay on the JVM side."""
