"""Column expressions shared by the operators. All of them stay in the JVM."""
