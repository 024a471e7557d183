"""Column expressions shared by the operators. All stay inside the JVM."""
