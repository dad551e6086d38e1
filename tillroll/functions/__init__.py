"""Column expressions shared by the plans; all of them stay in the JVM."""
