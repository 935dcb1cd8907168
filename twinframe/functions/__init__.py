"""Column functions: everything here is a built-in expression and stays in the JVM."""
