"""Column expressions. All are built from JVM-side functions and stay inside code generation."""
