"""Security-alert analytics as PySpark DataFrame operators."""
