"""Column expressions: everything here stays inside generated JVM code."""
