"""Column expressions shared by the layers. All of them stay inside the JVM."""
