"""Event-data operators for PySpark: windows, joins, change logs, patterns and streams."""
