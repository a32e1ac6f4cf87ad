"""Column expressions. Every function maps columns to a column and stays in the JVM."""
