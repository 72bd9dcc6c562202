"""Column functions; all of them built from JVM-side expressions."""
