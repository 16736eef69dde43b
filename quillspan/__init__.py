"""Document analytics on PySpark: sources, functions, operators, plans and streaming."""
