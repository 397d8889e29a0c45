"""Functions that return Columns; nothing here leaves the JVM."""
