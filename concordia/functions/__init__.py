"""Column-level functions; all but a few run inside the JVM."""
