"""Column-level expressions; all of them run inside the JVM."""
