"""Column-level helpers: schema parsing and JVM-side expressions."""
