"""Column functions: pure expressions on columns, evaluated inside the JVM except Porter stemming."""
