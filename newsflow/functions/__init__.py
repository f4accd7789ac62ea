"""Column functions: everything here but ``html`` is a built-in JVM expression."""
