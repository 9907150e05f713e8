"""Suspicious-review analytics as plain Spark DataFrame functions, for batch and for streams."""
