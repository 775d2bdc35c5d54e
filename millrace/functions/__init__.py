"""Column-level functions, JVM-side except where a codec needs bytes."""
