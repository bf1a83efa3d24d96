"""Column functions: every helper maps Columns to a Column and stays inside the JVM."""
