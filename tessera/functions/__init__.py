"""Column -> Column functions (all JVM-side, codegen friendly)."""
