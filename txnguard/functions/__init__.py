"""Column expressions: everything here is built in and stays in the JVM."""
