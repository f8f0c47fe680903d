"""Column -> Column building blocks; everything here stays in generated JVM code."""
