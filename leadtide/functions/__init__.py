"""Column expressions. All are built from native functions and stay in the JVM."""
