"""Column-level functions; every one is a built-in expression evaluated in the JVM."""
