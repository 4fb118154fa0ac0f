"""Column functions: binary fields, times and JSON text."""
