"""Column helpers: Column -> Column, evaluated inside the JVM."""
