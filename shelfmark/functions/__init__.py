"""Column functions. Everything here stays on the JVM side."""
