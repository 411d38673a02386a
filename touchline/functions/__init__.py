"""Column-level building blocks (pure ``Column`` expressions, JVM-side)."""
